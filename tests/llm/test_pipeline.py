"""The pipeline's stages and result against straightforward versions of the same decisions, on the smallest tables."""

from collections import Counter

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stocktake.llm import queries, sharding, toxicity
from workload.views import TABLES

from test_decontaminate import brute as contaminated
from test_jaccard import brute as groups
from test_mixing import fill
from test_sharding import brute as split
from llm_fixtures import documents  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        docs.write.parquet(f"{tmp_path}/{len(seen)}")
        docs = spark.read.parquet(f"{tmp_path}/{len(seen)}")
        seen.append([tuple(r) for r in docs.collect()])
        assert docs.columns == columns or len(seen) == len(corpus_pipeline.STAGES)
    every = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    quiet, single, clean, mixed, shards = seen

    ids, weights, bias = toxicity.model(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = toxicity.scores(pa.array([r[1] for r in every]), ids, weights, bias)
    assert sorted(quiet) == sorted(r for r, s in zip(every, scores) if s < 0.5)

    assert sorted(single) == sorted(r for r, (k, n, least) in zip(sorted(quiet), groups([r[:2] for r in sorted(quiet)])) if n == 0 or k == least)

    items = [(r["item_id"], r["text"].lower().split()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert sorted(clean) == sorted(r for r in single if r[0] not in {k for k, _ in contaminated([r[:2]], items)})

    sizes = Counter()
    for r in clean:
        sizes[r[3]] += len(r[1].split())
    used = Counter()
    for r in mixed:
        used[r[3]] += len(r[1].split())
    assert set(mixed) <= set(clean) and max(Counter(mixed).values()) <= 2
    longest = max(len(r[1].split()) for r in clean)
    for source, target in fill(sizes).items():
        assert abs(used[source] - target) <= longest

    want = split([r[:2] for r in mixed], sharding.LIMIT)
    assert len(shards) == len(mixed) and {s[3] for s in shards} == {v[0] for v in want.values()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(shards)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_sql(spark, db, name):
    df = queries.QUERIES[name](spark, SMALL)
    result = db.execute(queries.ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert _normal(df.collect(), df.columns) == _normal(result.fetchall(), columns)


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages_take_odd_rows(spark, documents):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(1, None, None), (2, "", "a"), (None, "some words of a text without an id", "a"), (3, "one", None), (3, "one", None), (4, long, "b"), (4, long, "b"), (5, long + " x", "a"), (6, "ONE", "c")]
    for docs in (documents(rows), documents([])):
        empty = not docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            found = sorted((str(r["doc_id"]), len(r["text"] or "")) for r in out.collect())
            if name.startswith("n-gram"):
                assert found == ([] if empty else sorted([("1", 0), ("2", 0), ("None", 34), ("3", 3), ("4", len(long))]))
            elif not name.startswith("mixing"):
                assert len(found) == (0 if empty else len(rows)), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == (0 if empty else len(rows))
