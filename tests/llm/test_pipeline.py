"""The pipeline over whole sf0.01 documents against a plain version of every stage."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from test_secrets import PLAIN
from test_simhash import plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from firmroll.llm import oracle
from firmroll.llm.secrets import MASK


def plain_quality(duck, docs):
    kept = {doc_id for doc_id, ok in duck.execute(f"select doc_id, kept from ({oracle.op10_quality_rules()})").fetchall() if ok}
    return {d: t for d, t in docs.items() if d in kept}


def plain_exact(docs):
    groups = defaultdict(list)
    for d, t in docs.items():
        groups[re.sub("[\x20\x09-\x0d]", "", t)].append((-len(t), d))
    return {min(g)[1]: docs[min(g)[1]] for g in groups.values()}


def plain_near(docs):
    prints = [(d, plain_fingerprint(t)) for d, t in sorted(docs.items())]
    root = {d: d for d, _ in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, p) in enumerate(prints):
        for b, q in prints[:i]:
            if (p ^ q).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: docs[d] for d, _ in prints if find(d) == d}


def plain_masked(text):
    spans = sorted(
        (m.start(), m.end()) for p, group, least in PLAIN.values() for m in p.finditer(text) if len(m.group(group)) >= least
    )
    out, at = "", 0
    for i, (a, b) in enumerate(spans):
        if i and a < at:
            at = max(at, b)
            continue
        out += text[at:a] + MASK
        at = b
    return out + text[at:]




def test_stages_and_result(spark, sf_dir, duck, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = {r.doc_id: r.text for r in docs.collect()}
    steps = {
        "quality_rules": lambda d: plain_quality(duck, d),
        "exact_dedup": plain_exact,
        "near_dedup": plain_near,
        "secret_scan": lambda d: {k: plain_masked(t) for k, t in d.items()},
    }
    assert [name for name, _ in corpus_pipeline.STAGES] == [*steps, "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        plain = steps[name](plain)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r.doc_id: r.text for r in docs.collect()} == plain
        assert docs.where("n_chars <> length(text)").count() == 0
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for d, t in plain.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for start in range(0, len(ids), 1024):
            part = ids[start : start + 1024]
            expected[(d, start, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in packed) == expected
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, packed))


def test_odd_documents(spark):
    """Null texts, null names, repeated rows and clashing columns pass every stage; empty tables stay empty."""
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text, "en", "s", len(text), "x")] * 2 + [(2, None, None, None, None, "x"), (None, text + " more", "en", "s", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, root string")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, "")
            found = out.collect()
            assert len(found) <= 4 and (frame is docs or not found)
