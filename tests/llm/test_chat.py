import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from firmroll.llm import chat


def brute(spark, rows, models):
    """Viterbi over whole conversations, line by line, by plain code: the best path to each role."""
    tied = rows.select("conv_id", "turn", "text", chat.F.xxhash64("text").alias("tie"),
                       chat.fold_of(folds=len(models)).alias("fold"), chat.F.monotonically_increasing_id().alias("copy"))
    groups = defaultdict(list)
    for r in chat.lines_of(tied).collect():
        groups[r.conv_id].append(r)
    out = Counter()
    for conv, members in groups.items():
        members.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.tie, r.copy, r.line))
        model = models[members[0].fold]
        n = len(model.roles)
        paths = [(float(model.start[i]) + score(model, members[0], i), [i]) for i in range(n)]
        for r in members[1:]:
            step = {0: np.where(np.eye(n) == 1, 0, -np.inf), 1: model.paragraph, 2: model.step}[r.follows]
            paths = [
                max(((s + float(step[p[-1], j]) + score(model, r, j), [*p, j]) for s, p in paths), key=lambda x: x[0])
                for j in range(n)
            ]
        best = max(paths, key=lambda x: x[0])[1]
        turns, before = [], None
        for r, i in zip(members, best, strict=True):
            if r.line == 0 or i != before or r.marker == i + 1:
                turns.append([conv, r.turn, 0 if r.line == 0 else turns[-1][2] + 1, r.text, model.roles[i]])
            else:
                turns[-1][3] += "\n" + r.text
            before = i
        out.update(map(tuple, turns))
    return out


def score(model, row, role):
    return sum(float(model.emit[name][role, row[name]]) for name in chat.FEATURES)


def recovered(rows, models):
    return Counter((r.conv_id, r.turn, r.part, r.text, r.role) for r in chat.recover_roles(rows, models).collect())


def test_whole_table_by_models_of_other_conversations(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    models = chat.fit(rows)
    assert len(models) == chat.FOLDS
    found = recovered(rows, models)
    assert found == brute(spark, rows, models)
    truth = {(r.conv_id, r.turn): r.role for r in rows.collect()}
    right = [truth[(c, t)] == role for c, t, _, _, role in found]
    assert sum(right) >= 0.9 * len(right)


def test_a_fold_is_not_fitted_on_itself(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    for fold, model in enumerate(chat.fit(rows)):
        alone = chat.fit(rows.where(chat.fold_of() != fold), folds=1)[0]
        assert np.allclose(model.start, alone.start) and np.allclose(model.step, alone.step)
        assert all(np.allclose(model.emit[name], alone.emit[name]) for name in chat.FEATURES)


def test_rows_that_hold_several_marked_turns(spark, sf_dir):
    """Each conversation of the table as one marked transcript: its turns and roles come out again."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    truth = sorted((r.conv_id, r.turn, r.role, r.text.rstrip()) for r in rows.collect())
    names = {"system": "System", "user": "Human", "assistant": "### Assistant"}
    whole = defaultdict(list)
    for conv, _, role, text in truth:
        whole[conv].append(f"{names[role]}: {text}")
    raw = spark.createDataFrame([(c, "\n".join(parts)) for c, parts in whole.items()], "conv_id long, text string")
    found = sorted(chat.format_chats(raw, labelled=rows).collect(), key=lambda r: (r.conv_id, r.part))
    by_place = defaultdict(list)
    for conv, _, role, text in truth:
        by_place[conv].append((role, f"<|{role}|>\n{text}<|end|>\n"))
    wanted = [(c, i, *turn) for c, turns in sorted(by_place.items()) for i, turn in enumerate(turns)]
    right = sum((r.conv_id, r.part, r.role, r.rendered) in set(wanted) for r in found)
    assert len(found) == len(wanted) and right >= 0.99 * len(wanted)


def test_query(spark, sf_dir):
    from firmroll.llm import registry

    rows = registry.queries()["op2_chat"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/conversations.parquet").count()
    assert all(r.rendered.startswith(f"<|{r.role}|>\n") and r.rendered.endswith("<|end|>\n") for r in rows)


@pytest.fixture
def models():
    rng = np.random.default_rng(4)

    def one():
        emit = {k: np.log(rng.dirichlet(np.ones(v), 3)) for k, v in chat.FEATURES.items()}
        start, step, paragraph = (np.log(rng.dirichlet(np.ones(3), size)) for size in (None, 3, 3))
        return chat.Model(chat.ROLES, start, step, emit, paragraph)

    return [one(), one()]


def test_one_conversation_over_many_partitions(spark, models):
    """A third of all messages in one conversation, null keys, repeated rows: the same as Viterbi over the whole."""
    rng = random.Random(2)
    texts = ["user: hi?", "Assistant: well\n\nmore\nUser: b\n \n\nc", "plain", "", None, "long " * 100, "a: b", "<|im_start|>system\nx", "what?"]
    rows = [(1, i, rng.choice(texts)) for i in range(400)]
    rows += [(10 + i // 5, i % 5, rng.choice(texts)) for i in range(700)]
    rows += [(None, i, rng.choice(texts)) for i in range(40)] + [(2, None, "x"), (2, 1, "y"), (2, 1, "y"), (2, 1, "z")]
    rows += [((1 << 62) + i % 2, (1 << 61) + i, "q?") for i in range(6)]
    messages = spark.createDataFrame([(*r, "u", 1) for r in rows], "conv_id long, turn long, text string, role string, part int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert recovered(messages, models) == brute(spark, messages, models)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert recovered(messages, models) == brute(spark, messages, models)
    assert chat.recover_roles(messages.limit(0), models).count() == 0
    assert chat.format_chats(messages.limit(0)).count() == 0


def test_copies_of_one_row(spark, models):
    """One row repeated for a third of the table, and rows without any key: each copy is parsed."""
    rows = [(1, 1, "user: a\nbot: b")] * 2000 + [(None, None, None)] * 500 + [(2, i, "x") for i in range(1500)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    found = recovered(messages, models)
    assert found == brute(spark, messages, models)
    assert sum(n for (c, *_), n in found.items() if c is None) == 500


def test_long_text_and_runs_of_blanks(spark, models):
    text = " " * 300_000 + "\n" + "a" + " " * 300_000 + "b\n" + "line\n" * 50_000 + "user: q\n" + "\n" * 1000
    rows = spark.createDataFrame([(1, text)], "conv_id long, text string")
    found = chat.format_chats(rows, models=models[:1]).collect()
    assert sum(r.rendered.count("line") for r in found) == 50_000 and not found[-1].rendered.endswith("\n<|end|>\n")


def test_a_marker_of_another_role_is_text(spark):
    start = {"system": 0.1, "user": 0.8, "assistant": 0.1}
    step = {(a, b): 1e-9 if a == b else 0.5 for a in chat.ROLES for b in chat.ROLES}
    model = chat.model_from(start, step)
    rows = spark.createDataFrame([(1, 0, "User: x"), (1, 1, "user: y"), (1, 2, "user: z")], "conv_id long, turn long, text string")
    found = chat.format_chats(rows, models=model).collect()
    assert [(r.turn, r.role, r.rendered) for r in sorted(found, key=lambda r: r.turn)] == [
        (0, "user", "<|user|>\nx<|end|>\n"), (1, found[1].role, f"<|{found[1].role}|>\nuser: y<|end|>\n"), (2, "user", "<|user|>\nz<|end|>\n"),
    ]


def test_raw_transcripts(spark):
    start = {"system": 0.2, "user": 0.7, "assistant": 0.1}
    step = {(a, b): 0.05 if a == b else 0.02 if b == "system" else 0.9 for a in chat.ROLES for b in chat.ROLES}
    raw = [
        (1, "System: be kind\nHuman: hello?\nAI: hi\nthere\n\nand you?\nAI: fine"),
        (2, "### User: q\n**Assistant**: a"),
        (3, None),
        (4, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>"),
    ]
    transcripts = spark.createDataFrame(raw, "conv_id long, text string")
    rows = sorted(chat.format_chats(transcripts, models=chat.model_from(start, step)).collect())
    roles = defaultdict(list)
    for r in rows:
        roles[r.conv_id].append((r.role, r.rendered.split("\n", 1)[1].removesuffix("<|end|>\n")))
    assert [x for x, _ in roles[1]] == ["system", "user", "assistant", "user", "assistant"]
    assert roles[1][2] == ("assistant", "hi\nthere") and roles[1][4] == ("assistant", "fine")
    assert roles[2] == [("user", "q"), ("assistant", "a")]
    assert roles[3] == [("user", "")]
    assert roles[4] == [("user", "hi"), ("assistant", "yo")]
