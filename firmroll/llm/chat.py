"""Chat formatting: parse transcripts, recover who speaks, render canonical turns.

Method: a hidden Markov model over lines. The hidden states are the roles, the observations are features of each line:
the speaker marker it begins with, if any, its length, whether it ends in a question, and how it follows the line
before it. A speaker may change where a row begins or a marker stands, with a small probability after an empty line,
and nowhere else. Viterbi's algorithm gives the likeliest roles; a turn is a stretch of lines of one row and role, cut
again at every marker that names the recovered role. A row may thus hold one message or a whole transcript.

Transitions and line features are counted over labelled rows; what a marker says about a role is a fixed parameter.
Conversations are dealt to folds, and each is parsed by the model of the other folds, never by its own labels.

Lines are sorted by (conversation, turn) over range partitions, so a conversation of any length is spread over
tasks; one row stays in one. Viterbi over a run of lines is a product of matrices in (max, +), and that product is
associative: each task reduces its runs to one matrix each, the matrices of those few conversations that span
partitions (at most two runs per partition) are chained to find the roles at the runs' ends, and each task then traces
its runs between given ends. The result is that of Viterbi over whole conversations.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmroll.llm.common import free_name, stored, text_or_empty

ROLES = ("system", "user", "assistant")
# Words that mark a speaker.
SPEAKERS = {
    "system": ("system", "instruction", "instructions"),
    "user": ("user", "human", "prompter", "customer", "question", "q", "you", "me"),
    "assistant": ("assistant", "bot", "ai", "gpt", "agent", "answer", "a", "model"),
}
_WORDS = "|".join(word for words in SPEAKERS.values() for word in words)
# Possessive, so that no run of blanks is read twice.
MARKER = (
    rf"(?i)^(?:\s*+<\|im_start\|>\s*+({_WORDS})[^\S\n]*+(?:\n|$)"
    rf"|[#>*\[<|\s]*+({_WORDS})\s*+[\]>|*]*+\s*+:[*]*+\s*+)"
)
# A marker names its own role with this probability; shares that outweigh any line feature.
MARKER_TRUE = 0.98
# The share of empty lines inside a row after which somebody else speaks without a marker.
PARAGRAPH_SWITCH = 0.001
FOLDS = 2
LENGTHS = 16
CONTINUED, PARAGRAPH, START = 0, 1, 2
FEATURES = {"marker": len(ROLES) + 1, "length": LENGTHS, "question": 2, "follows": 3}


@dataclass(frozen=True)
class Model:
    """Logarithms: ``start`` per role, ``step`` from role to role, ``emit`` per feature as role x value.

    ``paragraph`` is the step into a line after an empty one.
    """

    roles: tuple[str, ...]
    start: np.ndarray
    step: np.ndarray
    emit: dict[str, np.ndarray]
    paragraph: np.ndarray

    def scores(self, rows: pd.DataFrame) -> np.ndarray:
        """lines x roles."""
        return sum(self.emit[name][:, rows[name].to_numpy()].T for name in FEATURES)


def lines_of(rows: DataFrame, text: str = "text", line: str = "line") -> DataFrame:
    """One row per line of ``text``, with its number ``line`` and the columns of ``FEATURES``; other columns stay.

    A null text is one empty line. Lines end at ``\\n``.
    """
    split, piece = free_name(rows, "split"), free_name(rows, "piece")
    named = rows.withColumn(split, F.split(text_or_empty(text), "\n", -1))
    after_blank = F.transform(
        split,
        lambda value, i: F.struct(
            i.alias("line"), value.alias("text"), F.get(F.col(split), i - 1).rlike(r"^\s*+$").alias("after")
        ),
    )
    cut = named.withColumn(piece, F.explode(after_blank)).withColumns({text: F.col(f"{piece}.text")})
    word = F.lower(F.concat(*[F.regexp_extract(text, MARKER, group) for group in (1, 2)]))
    marker = F.lit(0)
    for i, role in enumerate(ROLES, start=1):
        marker = F.when(word.isin(*SPEAKERS[role]), i).otherwise(marker)
    cut = cut.withColumns({line: F.col(f"{piece}.line"), "marker": marker.cast("int")})
    starts = (F.col(line) == 0) | (F.col("marker") > 0)
    return cut.withColumns({
        "length": F.least(F.floor(F.log2(F.length(text) + 1)), F.lit(LENGTHS - 1)).cast("int"),
        "question": F.rtrim(text).endswith("?").cast("int"),
        "follows": F.when(starts, START).when(F.col(f"{piece}.after"), PARAGRAPH).otherwise(CONTINUED).cast("int"),
    }).drop(split, piece)


def fold_of(conv_id: str = "conv_id", folds: int = FOLDS) -> Column:
    """The fold of a conversation; a null one is a conversation like any other."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(conv_id).cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def _paragraph(step: np.ndarray, switch: float) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log((1 - switch) * np.eye(len(step)) + switch * np.exp(step))


def fit(labelled: DataFrame, folds: int = FOLDS, paragraph_switch: float = PARAGRAPH_SWITCH) -> list[Model]:
    """A model per fold, from all rows (conv_id, turn, role, text) of the *other* folds; with one fold, from all rows.

    Other roles than ROLES are passed over. Neighbours are found by a join on (conversation, turn), so no conversation
    is gathered. What comes to the driver is one count per fold and pair of roles, or per fold, role and feature value.
    """
    known = labelled.select("conv_id", "turn", "role", "text", fold_of(folds=folds).alias("fold"))
    known = known.where(F.col("role").isin(*ROLES))
    turns = known.groupBy("fold", "conv_id", "turn").agg(F.min("role").alias("role"))
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("was"))
    pairs = turns.join(before, ["conv_id", "turn"], "left").groupBy("fold", "was", "role")
    index = {role: i for i, role in enumerate(ROLES)}
    start, step = np.zeros((folds, len(ROLES))), np.zeros((folds, len(ROLES), len(ROLES)))
    for r in pairs.agg(F.count(F.lit(1)).alias("n")).collect():
        if r["was"] is None:
            start[r["fold"], index[r["role"]]] += r["n"]
        else:
            step[r["fold"], index[r["was"]], index[r["role"]]] += r["n"]
    seen = {name: np.zeros((folds, len(ROLES), bound)) for name, bound in FEATURES.items() if name != "marker"}
    stacked = lines_of(known).select("fold", "role", F.explode(F.array(*[
        F.struct(F.lit(k).alias("feature"), F.col(k).alias("value")) for k in seen
    ])).alias("f"))
    for r in stacked.groupBy("fold", "role", "f.feature", "f.value").agg(F.count(F.lit(1)).alias("n")).collect():
        seen[r["feature"]][r["fold"], index[r["role"]], r["value"]] += r["n"]

    def shares(counts: np.ndarray, fold: int) -> np.ndarray:
        others = 1 + counts.sum(axis=0) - (counts[fold] if folds > 1 else 0)
        return np.log(others / others.sum(axis=-1, keepdims=True))

    models = []
    for fold in range(folds):
        moves = shares(step, fold)
        emit = {"marker": _marker_scores()} | {name: shares(counts, fold) for name, counts in seen.items()}
        models.append(Model(ROLES, shares(start, fold), moves, emit, _paragraph(moves, paragraph_switch)))
    return models


def _marker_scores() -> np.ndarray:
    """No marker says nothing; a marker names its own role nearly always."""
    wrong = (1 - MARKER_TRUE) / (len(ROLES) - 1)
    named = np.where(np.eye(len(ROLES)) == 1, MARKER_TRUE, wrong)
    return np.log(np.hstack([np.ones((len(ROLES), 1)), named]))


def segments(model: Model, rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of lines in which nobody else can begin to speak: where they start, their scores, how they follow."""
    follows = rows["follows"].to_numpy()
    starts = np.flatnonzero(follows != CONTINUED)
    return starts, np.add.reduceat(model.scores(rows), starts, axis=0), follows[starts]


def trace(
    model: Model, scores: np.ndarray, follows: np.ndarray, entry: int | None = None, last: int | None = None
) -> np.ndarray:
    """Viterbi over a run: the likeliest roles, given the role before the run and the one at its end, if known."""
    best = (model.start if entry is None else model.step[entry]) + scores[0]
    back = np.zeros((len(scores), len(model.roles)), np.int8)
    for i in range(1, len(scores)):
        through = best[:, None] + (model.paragraph if follows[i] == PARAGRAPH else model.step)
        back[i] = through.argmax(axis=0)
        best = through.max(axis=0) + scores[i]
    path = np.zeros(len(scores), np.int64)
    path[-1] = best.argmax() if last is None else last
    for i in range(len(scores) - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def reduced(model: Model, scores: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """The run as a matrix: from each role before it, and from no role (last row), to each role at its end."""
    best = np.vstack([model.step, model.start]) + scores[0]
    for row, kind in zip(scores[1:], follows[1:], strict=True):
        step = model.paragraph if kind == PARAGRAPH else model.step
        best = (best[:, :, None] + step[None]).max(axis=1) + row
    return best


def chained(matrices: Sequence[np.ndarray]) -> list[tuple[int | None, int]]:
    """(role before, role at the end) of each run of a conversation."""
    best, back = matrices[0][-1], []
    for matrix in matrices[1:]:
        through = best[:, None] + matrix[:-1]
        back.append(through.argmax(axis=0))
        best = through.max(axis=0)
    ends = [int(best.argmax())]
    for pointers in reversed(back):
        ends.append(int(pointers[ends[-1]]))
    ends.reverse()
    return list(zip([None, *ends[:-1]], ends, strict=True))


def _starts(rows: pd.DataFrame, keys: tuple[str, ...]) -> np.ndarray:
    """Row numbers at which a run begins: neighbouring rows with equal keys, nulls alike, are one run."""
    new = np.zeros(len(rows), bool)
    new[0] = True
    for key in keys:
        column, before = rows[key], rows[key].shift()
        new |= (column.ne(before) & ~(column.isna() & before.isna())).to_numpy()
    return np.flatnonzero(new)


def _whole_runs(batches: Iterator[pd.DataFrame], *keys: str) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """The rows of a sorted partition in frames that end with a run, and where runs begin in each."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        last = int(_starts(batch, keys)[-1])
        goes_on = bool(held) and len(_starts(pd.concat([held[-1].tail(1), batch.head(1)]), keys)) == 1
        if last == 0 and (goes_on or not held):
            held.append(batch)
            continue
        rows = pd.concat([*held, batch.iloc[:last]], ignore_index=True)
        yield rows, _starts(rows, keys)
        held = [batch.iloc[last:]]
    if held:
        rows = pd.concat(held, ignore_index=True)
        yield rows, _starts(rows, keys)


def recover_roles(rows: DataFrame, models: Model | Sequence[Model]) -> DataFrame:
    """Parse rows (conv_id, turn, text) into turns (conv_id, turn, part, role, marked, text) by Viterbi over lines.

    ``part`` counts the turns of one row from 0; ``marked`` tells whether the turn begins with a marker of its role.
    Any role that the rows have is not looked at. With several models, a conversation takes that of its fold. The rows
    of a conversation are ordered by turn, then by a hash of the text; null conversations count as one, null turns
    come first, a null or empty text is one empty turn; repeated rows are parsed each; other columns are left out. A
    very long text is parsed line by line in one task, which holds the lines of a partition's largest conversation.
    """
    models = [models] if isinstance(models, Model) else list(models)
    types = dict(rows.dtypes)
    # Copies of a row are told apart by ``copy``, so that any number of them is spread.
    order = ["conv_id", "turn", "tie", "copy"]
    plain = rows.select(
        "conv_id", "turn", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("copy"),
        fold_of(folds=len(models)).alias("fold"), "text",
    )
    dealt = lines_of(plain).repartitionByRange(*order).sortWithinPartitions(*order, "line")
    # As text, keys of any kind pass through pandas unchanged, whole numbers beside nulls too.
    dealt = dealt.withColumns({name: F.col(name).cast("string") for name in ("conv_id", "turn")}).drop("tie", "copy")
    fields = ", ".join(f"{name} int" for name in ("fold", "line", *FEATURES))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, place = TaskContext.get().partitionId(), 0
        for lines, starts in _whole_runs(batches, "conv_id"):
            ends = [*starts[1:], len(lines)]
            matrix: list = [None] * len(lines)
            for i, j in zip(starts, ends, strict=True):
                model = models[lines["fold"].iloc[i]]
                _, scores, follows = segments(model, lines.iloc[i:j])
                matrix[j - 1] = reduced(model, scores, follows).ravel().tolist()
            yield lines.assign(task=task, place=range(place, place + len(lines)), matrix=matrix)
            place += len(lines)

    schema = f"conv_id string, turn string, text string, {fields}, task int, place long, matrix array<double>"
    sorted_lines = stored(dealt.mapInPandas(placed, schema), "chat")
    runs = sorted_lines.where(F.col("matrix").isNotNull()).select("conv_id", "task", "matrix")
    spanning = runs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv_id")
    few = runs.join(spanning, runs["conv_id"].eqNullSafe(spanning["conv_id"]), "left_semi")
    shape = (len(ROLES) + 1, len(ROLES))

    def ends(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("task")
        known = chained([np.array(m).reshape(shape) for m in found["matrix"]])
        return pd.DataFrame({
            "ends_conv": found["conv_id"], "ends_task": found["task"],
            "entry": [-1 if e is None else e for e, _ in known], "last": [x for _, x in known],
        })

    fixed = few.groupBy("conv_id").applyInPandas(
        ends, "ends_conv string, ends_task int, entry int, last int"
    )
    fixed = stored(fixed, "chat-ends")
    joined = sorted_lines.drop("matrix").join(
        fixed, F.col("conv_id").eqNullSafe(F.col("ends_conv")) & (F.col("task") == F.col("ends_task")), "left"
    ).drop("ends_conv", "ends_task")

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lines, starts in _whole_runs(batches, "task", "conv_id"):
            entry, last = (lines[c].fillna(-1).astype(int).to_numpy() for c in ("entry", "last"))
            turns = []
            for i, j in zip(starts, [*starts[1:], len(lines)], strict=True):
                # -1: nothing comes before, or the end is free.
                known = [None if x < 0 else int(x) for x in (entry[i], last[i])]
                turns += turns_of(models[lines["fold"].iloc[i]], lines.iloc[i:j], *known)
            yield pd.DataFrame(turns, columns=["conv_id", "turn", "part", "role", "marked", "text"])

    # A task's lines are what one range partition held, so these are as even as those.
    again = joined.repartition("task").sortWithinPartitions("task", "place")
    found = again.mapInPandas(
        traced, "conv_id string, turn string, part int, role string, marked boolean, text string"
    )
    return found.withColumns({name: F.col(name).cast(types[name]) for name in ("conv_id", "turn")})


def turns_of(
    model: Model, lines: pd.DataFrame, entry: int | None, last: int | None
) -> list[tuple[str, str, int, str, bool, str]]:
    """The turns (conv_id, turn, part, role, marked, text) of a run of lines of one conversation."""
    starts, scores, follows = segments(model, lines)
    path = trace(model, scores, follows, entry, last)
    number, marker = lines["line"].to_numpy()[starts], lines["marker"].to_numpy()[starts]
    marked = marker == path + 1
    # A stretch goes on the turn before it, unless a row begins, the role changes or its marker is right.
    new = (number == 0) | marked
    new[1:] |= path[1:] != path[:-1]
    first = np.flatnonzero(new)
    texts, cuts = lines["text"].tolist(), [*starts[first], len(lines)]
    turns, part = [], 0
    for k, at in enumerate(first):
        part = 0 if number[at] == 0 else part + 1
        row = lines.iloc[cuts[k]]
        text = "\n".join(texts[cuts[k] : cuts[k + 1]])
        turns.append((row["conv_id"], row["turn"], part, model.roles[path[at]], bool(marked[at]), text))
    return turns


def rendered(turns: DataFrame) -> DataFrame:
    """Canonical turns: the text without its marker, between a role tag and an end tag."""
    body = F.when(F.col("marked"), F.regexp_replace("text", MARKER, "")).otherwise(F.col("text"))
    body = F.regexp_replace(body, r"(?<!\s)\s*+(?:<\|im_end\|>)?\s*+$", "")
    return turns.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), body, F.lit("<|end|>\n")))


def format_chats(
    rows: DataFrame, labelled: DataFrame | None = None, models: Model | Sequence[Model] | None = None
) -> DataFrame:
    """One row per turn: conv_id, turn, part, role (recovered), rendered. ``rows`` without ``turn`` are whole transcripts.

    Without ``models``, these are fitted on ``labelled``, or else on the rows' own roles across folds. Nulls, ties,
    repeated rows, very long texts and other columns are as in :func:`recover_roles`; an empty table gives none.
    """
    models = models or fit(rows if labelled is None else labelled)
    wanted = rows if "turn" in rows.columns else rows.withColumn("turn", F.lit(0))
    found = recover_roles(wanted.select("conv_id", "turn", "text"), models)
    return rendered(found).select("conv_id", "turn", "part", "role", "rendered")


def model_from(
    start: Mapping[str, float], step: Mapping[tuple[str, str], float], paragraph_switch: float = 0.5
) -> Model:
    """A model with given probabilities and no line features, for transcripts without labelled examples."""
    emit = {name: np.zeros((len(ROLES), bound)) for name, bound in FEATURES.items()} | {"marker": _marker_scores()}
    moves = np.log([[step[(a, b)] for b in ROLES] for a in ROLES])
    return Model(ROLES, np.log([start[r] for r in ROLES]), moves, emit, _paragraph(moves, paragraph_switch))
