"""The pipeline's stages on a small table: decisions take effect, columns stay, clean documents are kept."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline as C  # noqa: E402
import data  # noqa: E402


def test_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(data.table(spark, [(10 ** 6 + (r[0] or 0), *r[1:]) for r in data.rows() if r[0] is None or r[0] >= 100]))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    before = {r.doc_id for r in docs.collect()}
    for name, f in C.STAGES:
        out = f(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != C.STAGES[-1][0]:
            assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
        assert {r.doc_id for r in after.select("doc_id").collect()} <= before
        if name == "language_id":
            assert after.count() > 0.95 * 200
        if name == "near_dup":
            assert after.count() == after.select("doc_id", "text").distinct().count()
        docs = after
    assert docs.filter("not round_trip").count() == 0
    rows = C.run(spark, str(tmp_path))
    assert rows.columns == docs.columns and rows.count() == docs.count()


def test_stages_against_brute_force(spark, tmp_path):
    import re
    from collections import Counter

    import public_tokenizers as P
    from test_operators import check_deduplicated, words
    from tokenizers import Tokenizer

    from pitchside.llm import language_id, pii, source_mix

    clean = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = clean.unionByName(data.table(spark, [(10 ** 6 + i, *r[1:]) for i, r in enumerate(data.rows()) if r[0] is None or r[0] >= 100]))
    stages = dict(C.STAGES)

    def stage(name, docs):
        stages[name](spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        return out, list(map(tuple, docs.collect())), list(map(tuple, out.collect()))

    docs.write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    said = Counter(r.doc_id for r in language_id.identify(docs).collect() if r.lang_pred != "und" and r.score >= 0.3)
    docs, before, got = stage("language_id", docs)
    assert Counter(r[0] for r in got) == said and not Counter(got) - Counter(before)
    assert {r.doc_id for r in clean.collect()} <= set(said)
    assert not [r for r in got if not re.search(r"[^\W\d_]", r[1] or "")]

    docs, before, got = stage("near_dup", docs)
    check_deduplicated(before, got, 5, 0.8)

    found = {(r.doc_id, r.spans) for r in pii.find_pii(docs).collect()}
    assert len(found) == len(got) == len({r[0] for r in got})
    spans = dict(found)
    docs, before, got = stage("pii", docs)
    at = docs.columns.index("n_chars")
    want = []
    for r in before:
        text, end = "", 0
        for kind, a, b in sorted((x.split(":") for x in spans[r[0]].split(",") if x), key=lambda x: int(x[1])):
            if int(a) >= end:
                text += r[1][end : int(a)] + f"[{kind.upper()}]"
            end = max(end, int(b))
        text += r[1][end:]
        want.append((r[0], text, *r[2:at], len(text), *r[at + 1 :]))
    assert Counter(got) == Counter(want)

    docs, before, got = stage("source_mix", docs)
    assert set(got) <= set(before)
    copies, by = Counter(got), {}
    for r in before:
        by.setdefault(r[3], []).append((len(words(r[1])), copies[r]))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    target = data.quotas([sum(n for n, _ in by[s]) for s in names], [1.0 + i % 3 for i in range(len(names))])
    for s, t in zip(names, target):
        sized = [(n, c) for n, c in by[s] if n]
        least, most = min(c for _, c in sized), max(c for _, c in sized)
        miss = round(t) - sum(n * c for n, c in sized)
        assert most - least <= 1 and most <= 3
        # no document more, or less, would still fit
        assert all(n > abs(miss) for n, c in sized if miss and c == (least if miss > 0 else most) and (miss < 0 or c < 3))

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs, before, got = stage("bpe", docs)
    ids, n = docs.columns.index("ids"), docs.columns.index("n_tokens")
    want = Counter((r[0], tuple(t.encode(r[1], add_special_tokens=False).ids)) for r in before)
    assert Counter((r[0], tuple(r[ids])) for r in got) == want and all(len(r[ids]) == r[n] for r in got)


def test_empty(spark):
    docs = data.table(spark, [])
    for _, f in C.STAGES:
        out = f(spark, docs, "")
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs


def test_registered(spark):
    import __spark_entry__ as E

    names = list(E.queries())
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14))


@pytest.mark.parametrize("name", ["op8_quality_rules", "op11_line_dedup"])
def test_oracles(spark, name):
    from collections import Counter

    from pitchside.llm.queries import ORACLE_SQL, QUERIES
    from tools.oracle_check import duck, rows_of

    df = QUERIES[name](spark, "/root/testdata/sf0.01")
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck("/root/testdata/sf0.01").execute(ORACLE_SQL[name])
    b, bc = rows_of([d[0] for d in res.description], res.fetchall())
    assert ac == bc and Counter(a) == Counter(b)
