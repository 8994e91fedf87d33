"""The pipeline and the registered queries on small tables, stage by stage against brute force."""

import collections
import glob
import hashlib
import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F
from test_llm_operators import AWKWARD, documents, join_by_hand, near_copies, prose, tiling_by_hand, toxic_set

import __spark_entry__
import corpus_pipeline
from screenweave.llm import common, context_tree, language_id, ngram_join, string_tiling, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of documents, labels and benchmark with planted cases; documents have an extra column of a clashing name."""
    path = str(tmp_path_factory.mktemp("sf"))
    texts, labels = toxic_set(400)
    n = len(texts)
    texts += near_copies(8, 80, 1, 6) + [texts[1], texts[2]]
    item = prose(90_077, 30)
    texts += [f"{prose(90_500, 40)} {item} {prose(90_501, 40)}", " ".join(item.split()[15:] + [prose(90_502, 20)] + item.split()[:15])]
    texts += [None, "", "12 34 !!", "x"]
    documents(spark, texts, sources=[f"s{k % 3}" for k in range(len(texts))]).withColumnRenamed("score", "matches").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(labels[k])) for k in range(n)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, prose(90_078, 30)), (3, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        given = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = corpus_pipeline.written(stage(spark, docs, folder), name)
        kept = {r["doc_id"] for r in docs.collect()}
        assert kept <= set(given)
        if name != "source_mixing":
            assert docs.columns == columns
        ids = sorted(given)
        if name == "language_id":
            assert set(given) - kept == {k for k in ids if not any(c.isalpha() for c in given[k] or "")}
        elif name == "toxicity":
            bad = {k for k in ids if any(w in (given[k] or "") for w in ("vilex", "grubby", "zorg"))}
            assert len(bad & kept) <= 0.1 * len(bad) and len(set(ids) - bad - kept) <= 0.05 * len(ids)
        elif name == "near_duplicates":
            hand = join_by_hand([given[k] for k in ids], 5, 80)
            assert kept == {k for k, (_, _, root) in zip(ids, hand) if ids[root] == k}
            assert len(kept) < len(ids)
        elif name == "decontamination":
            items = [r["text"].split() for r in spark.read.parquet(f"{folder}/benchmark.parquet").dropna().collect()]
            dirty = {k for k in ids for i in items if sum(t[2] for t in tiling_by_hand(given[k].lower().split(), i, 4)) >= 0.5 * len(i)}
            assert kept == set(ids) - dirty and len(dirty) == 2
        else:
            assert kept == set(ids)


def test_near_duplicates_of_repeated_ids(spark):
    x, y, z = prose(1, 30), prose(2, 30), prose(3, 30)
    rows = [(3, y), (7, x), (7, y), (9, x), (5, z), (5, z), (5, z), (4, z + " more"), (11, prose(4, 30)), (11, prose(5, 30)), (None, x), (6, ""), (6, "")]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    out = ngram_join.stage(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in out.collect()))
    assert got == sorted([(3, y), (7, x), (4, z + " more"), *rows[8:10], (0, x), *rows[11:]])
    again = ngram_join.stage(spark, docs.where("doc_id = 5"), "").collect()
    assert [(r["doc_id"], r["text"], r["block"]) for r in again] == [(5, z, 7)]


def shuffled(spark):
    """Shuffle files on disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_near_duplicates_leave_no_large_files(spark, monkeypatch, tmp_path):
    """Neither shuffle files of written tables nor posts stay once they are read; documents don't move for the few that go."""
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    before = shuffled(spark)
    common.written(spark.range(1000).repartition(3, "id"), "dealt").count()
    texts = [*near_copies(5, 60, 1, 9), *(prose(k, 30) for k in range(40))]
    out = ngram_join.stage(spark, documents(spark, texts), "")
    for _ in range(20):  # files are deleted a little later
        if not (stay := shuffled(spark) - before):
            break
        time.sleep(0.5)
    assert sum(os.path.getsize(f) for f in stay) < 5000  # of counts that are collected only
    left = {p.name.rsplit("-", 5)[0] for p in tmp_path.iterdir()}
    assert "profile" in left and not left & {"posts", "kept"}
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == len({root for _, _, root in join_by_hand(texts, 5, 80)})


@pytest.mark.parametrize("group,counted", [(3, 7), (40, 7), (40, 1000), (700, 50)])
def test_very_frequent_shingles_are_counted_in_full(spark, monkeypatch, group, counted):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    monkeypatch.setattr(ngram_join, "COUNTED", counted)
    values = [k % 50 if k % 3 else k % 4 for k in range(1500)]
    posts = spark.createDataFrame([(v,) for v in values], "shingle long").repartition(5)
    want = {v for v, n in collections.Counter(values).items() if n > group}
    assert {r["shingle"] for r in ngram_join.very_frequent(posts).collect()} == want
    assert ngram_join.very_frequent(posts.limit(0)).count() == 0


def test_run_keeps_the_last_table_only(spark, folder, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, lambda spark, docs, _, k=k: docs.where(f"doc_id % 7 <> {k}")) for k, n in enumerate(("first", "second", "third"))])
    out = corpus_pipeline.run(spark, folder)
    assert [p.name[:5] for p in tmp_path.iterdir()] == ["third"]
    assert out.count() == spark.read.parquet(f"{folder}/documents.parquet").where("doc_id % 7 > 2").count()


def test_run_and_empty(spark, folder, tmp_path):
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 0 and "doc_id" in out.columns
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_take_awkward_rows(spark, folder):
    docs = documents(spark, AWKWARD, sources=[None] * len(AWKWARD))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars", "score", "block", "id", "p"}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= 3


def test_queries_are_whole(spark):
    """Every query returns each row of its table once, with the columns of its contract."""
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    want = {
        "op1": {"doc_id", "held_out", "lang_pred", "score"},
        "op4": {"doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"},
        "op5": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
        "op7": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
        "op8": {"doc_id", "n_shingles", "component_id"},
        "op10": {"doc_id", "held_out", "score", "predicted"},
    }
    for name, f in __spark_entry__.queries().items():
        op = name.split("_")[0]
        if op in want:
            df = f(spark, SF)
            assert want[op] <= set(df.columns)
            key = "page_id" if op == "op7" else "doc_id"
            rows = df.select(key).collect()
            assert len({r[0] for r in rows}) == len(rows) == (n if op != "op7" else spark.read.parquet(f"{SF}/pages.parquet").count())


@pytest.mark.parametrize("name", ["op3_license_scan", "op7_warc_transactions", "op8_ngram_jaccard"])
def test_query_gives_what_sql_gives(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    con.sql(__spark_entry__.oracle_sql()[name]).create("wanted")
    got = __spark_entry__.queries()[name](spark, SF)
    cols = sorted(got.columns)
    show = lambda rows: sorted(tuple("null" if v is None else str(v) for v in r) for r in rows)
    assert show(got.select(*cols).collect()) == show(con.sql(f"select {', '.join(cols)} from wanted").fetchall())


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    lang = language_id.query(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert lang.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    lm = context_tree.query(spark, sf).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.avg("bits_per_byte")).first()
    assert lm[2] < 3 and lm[0] > 1.05 * lm[1]
    tox = toxicity.query(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in tox) / len(tox) > 0.9


def test_whole_tables_against_plain_counting(spark):
    """Matches of whole passages, and exact copies, in the small tables."""
    docs = {r["doc_id"]: " ".join((r["text"] or "").lower().split()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: " ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r["doc_id"], r["item_id"]) for r in string_tiling.query(spark, SF).collect()}
    assert {(d, i) for d, t in docs.items() for i, x in items.items() if f" {x} " in f" {t} "} <= found
    copies = collections.defaultdict(list)
    for d, t in docs.items():
        copies[hashlib.md5(t.encode()).hexdigest()].append(d)
    component = {r["doc_id"]: r["component_id"] for r in ngram_join.query(spark, SF).collect()}
    assert all(len({component[d] for d in ds}) == 1 for ds in copies.values())
