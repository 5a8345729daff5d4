"""Physical plans as text."""

import contextlib
import io
import re


def explained(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def operators(df):
    """Names of the physical operators, in the order of the plan tree."""
    tree = explained(df).split("\n\n")[0]
    return re.findall(r"([A-Z]\w+(?: \w+)*?) +(?:\S+ +)?\(\d+\)", tree)
