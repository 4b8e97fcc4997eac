"""The pipeline, its queries, and each stage on its own input."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from starloom.llm.queries import ORACLE, QUERIES

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        new = corpus_pipeline.materialize(stage(spark, docs, SF_SMALL), "stage")
        out.append((docs, new))
        docs = new
    return out


def test_registered():
    assert sorted(int(q.split("_")[0][2:]) for q in QUERIES) == list(range(1, 11))
    assert "pipeline" in entry.queries() and set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_keep_the_columns(stages):
    for docs, new in stages[:-1]:
        assert new.dtypes == docs.dtypes
        assert new.count() <= docs.count()


def test_quality_stage(spark, stages):
    docs, new = stages[0]
    kept = {r.doc_id for r in new.select("doc_id").collect()}
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()
    clean = [r.doc_id for r in labels if r.quality == 1 and r.toxic == 0]
    bad = [r.doc_id for r in labels if r.quality == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and sum(i in kept for i in bad) <= 0.4 * len(bad)
    assert {tuple(r) for r in new.collect()} <= {tuple(r) for r in docs.collect()}


def test_near_dedup_stage(stages):
    from test_simhash import brute_fingerprint

    docs, new = stages[1]
    rows = docs.orderBy("doc_id").collect()
    bits = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    group = {i: i for i in bits}
    order = sorted(bits)
    for a in order:
        for b in order:
            if a < b and (bits[a] ^ bits[b]).bit_count() <= 3:
                x, y = group[a], group[b]
                group = {i: min(x, y) if g in (x, y) else g for i, g in group.items()}
    assert sorted(r.doc_id for r in new.collect()) == sorted(set(group.values()))


def test_substring_stage(stages):
    docs, new = stages[2]
    before = {r.doc_id: r.text.split() for r in docs.collect()}
    seen, after = set(), {r.doc_id: r.text.split() for r in new.collect()}
    for i in sorted(before):
        w = before[i]
        gone, own = set(), []
        for s in range(len(w) - 49):
            t = tuple(w[s : s + 50])
            if t in seen:
                gone |= set(range(s, s + 50))
            own.append(t)
        seen.update(own)
        assert after.get(i, []) == [x for k, x in enumerate(w) if k not in gone]
        assert i in after or w


def test_decontamination_stage(spark, stages):
    docs, new = stages[3]
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in docs.collect() if any(t in r.text for t in items)}
    kept = {r.doc_id for r in new.collect()}
    assert not leaks & kept and len(kept) >= docs.count() - len(leaks) - 2


def test_pieces_stage(stages):
    docs, new = stages[4]
    assert new.count() == docs.count() and new.filter("not same").count() == 0


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted((r.doc_id, r.ids_crc32) for r in got.collect()) == sorted((r.doc_id, r.ids_crc32) for r in stages[-1][1].collect())


def test_stages_take_odd_rows(spark):
    """Null, empty, very long, repeated and equal-id rows; then no rows at all."""
    from starloom.llm.cotraining import TARGETS

    long = " ".join(f"w{i % 977} of" for i in range(60_000))
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (None, None, "en", "s", 0), (2, "a few plain words", "en", "s", 17),
            (2, "a few plain words", "en", "s", 17), (2, "other words for the same id", "de", None, 27), (3, long, "en", "s", len(long)), (4, long + " end", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    by_name = dict(corpus_pipeline.STAGES)
    assert len(TARGETS) == 2
    kept = by_name["quality classifier"](spark, docs, SF_SMALL)
    assert kept.dtypes == docs.dtypes
    near = by_name["SimHash near-dedup"](spark, docs, SF_SMALL).collect()
    # the texts without words are one class (id 1), the rows of id 2 with the same text one document, the long ones near copies
    assert sorted((r.doc_id, r.text) for r in near if r.text) == [(2, "a few plain words"), (2, "other words for the same id"), (3, long)]
    assert [r.doc_id for r in near if not r.text] == [1]
    cut = by_name["substring dedup"](spark, docs, SF_SMALL).collect()
    assert sorted(str(r.doc_id) for r in cut) == ["1", "2", "2", "2", "3", "4", "None", "None"]
    assert {r.doc_id: r.text for r in cut}[4] == "end" and {r.doc_id: r.n_chars for r in cut}[4] == 3
    clean = by_name["benchmark decontamination"](spark, docs, SF_SMALL)
    assert clean.count() == len(rows)
    pieces = by_name["SentencePiece"](spark, docs, SF_SMALL).collect()
    assert len(pieces) == len(rows) and all(r.same for r in pieces) and sorted(r.n_tokens for r in pieces)[:3] == [0, 0, 0]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, cursor.fetchall()))
