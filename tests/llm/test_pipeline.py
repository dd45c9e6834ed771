"""The pipeline: what each stage rejects, and its form."""

from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from recordloom.llm import mixing, ngram_join, queries
from recordloom.llm.common import landed
from tools.check_queries import rows_of


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, sf, con, name):
    df = queries.QUERIES[name](spark, sf)
    res = con.execute(queries.SQL[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in res.description], res.fetchall())


def test_stages_keep_columns_and_take_effect(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")  # a dozen toxic labels teach nothing
    docs = left = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = []
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = left
        left = landed(stage(spark, left, sf), "stage")
        sizes.append(left.count())
        ids = {r.doc_id for r in left.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name != "sharding":
            assert left.columns == docs.columns
            assert left.exceptAll(before).isEmpty()
        if name == "toxicity":
            assert len(toxic & ids) <= 0.4 * len(toxic) and sizes[-1] >= 0.8 * docs.count()
        if name == "ngram_jaccard":
            groups = ngram_join.similar(before).collect()
            assert ids == {r.component_id for r in groups}
            assert max(Counter(r.component_id for r in ngram_join.similar(left).collect()).values()) == 1
        if name == "decontamination":
            leaks = {r.doc_id for r in entry.queries()["op1_decontamination"](spark, sf).where("contaminated").collect()}
            assert not ids & leaks and {r.doc_id for r in before.collect()} - ids <= leaks
        if name == "source_mix":  # rows lie in the order of the mix
            mixed = [r.doc_id for r in mixing.stored_order(left).orderBy("_file", "_nth").collect()]
            places = {r.doc_id: r.place for r in mixing.schedule(before, cap=None).select("row.doc_id", "place").collect()}
            assert [places[d] for d in mixed] == sorted(places.values())
        if name == "sharding":
            assert left.columns == [*docs.columns, "size", "text_crc32", "shard", "slot"]
            slots = defaultdict(list)
            for r in left.orderBy("shard", "slot").collect():
                assert r.slot == len(slots[r.shard]) and r.text is not None
                slots[r.shard].append(r.doc_id)
            order = {d: i for i, d in enumerate(mixed)}
            assert all([order[d] for d in ids] == sorted(order[d] for d in ids) for ids in slots.values())
    assert corpus_pipeline.run(spark, sf).count() == sizes[-1]


def test_stages_bear_odd_rows(spark, sf, odd, empty):
    for rows in (odd, empty):
        left = rows
        for name, stage in corpus_pipeline.STAGES:
            left = stage(spark, left, sf)
            added = ["size", "text_crc32", "shard", "slot"]
            assert left.columns == (rows.columns if name != "sharding" else [*[c for c in rows.columns if c not in added], *added])
            left = landed(left, "odd")
        assert left.count() <= rows.count() and left.select("slot").distinct().count() <= left.count()
