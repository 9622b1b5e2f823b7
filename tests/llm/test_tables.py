"""Archives, vectors and the pipeline."""

import base64
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemerge.llm import rp_forest, vector_graph, warc
from tidemerge.llm.components import Forest

# ----------------------------------------------------------------- archives


def pages(spark):
    rows = [(i, f"http://x/{i}\r\nEvil: 1 é", "<p>same</p>" if i % 3 == 0 else f"<p>ü {i}</p>\r\n\r\n") for i in range(40)]
    rows += [(100, None, None), (101, "u", ""), (101, "u", ""), (None, "u", ""), (None, None, "alone"), (200, "u", "long " * 200_000)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit("x"))


def expected(rows, least=0):
    groups = {}
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [x for x in groups[data] if x is not None]
        last = max(ids) if ids and len(groups[data]) > 1 and len(data) >= least else i
        again = i != last
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", last if again else None))
    return sorted(out, key=str)


def test_archives_come_back(spark, tmp_path):
    rows, df = pages(spark)
    got = warc.archived_pages(df, f"file://{tmp_path}").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


@pytest.mark.parametrize("least", [0, 12])
def test_least_size_of_revisits(spark, tmp_path, least):
    rows, df = pages(spark)
    path = f"file://{tmp_path}/a"
    warc.write_archives(df, path, least)
    got = warc.read_archives(spark, path).where("record_type != 'warcinfo'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, least)


def test_payloads_and_predicates(spark, tmp_path):
    rows, df = pages(spark)
    path = f"file://{tmp_path}/a"
    warc.write_archives(df, path)
    back = warc.read_archives(spark, path, payload="bytes").where("record_type = 'response' AND page_id >= 30 AND page_id < 101")
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in back.collect()}
    want = {i: html or "" for i, _, html in rows if i is not None and 30 <= i < 101 and (i % 3 or i == 39) and i != 100}
    assert got == want
    assert "page_id" not in back._jdf.queryExecution().executedPlan().toString().split("Filter", 1)[-1].split("BatchScan")[0] or back.count() == len(want)


def test_unwanted_blocks_are_not_decoded(tmp_path):
    """Neither reader touches the block of a record that headers rule out."""
    import io

    a = warc.record("response", 1, "u", b"x" * 1000, 1000, warc.digest(b"x" * 1000), None)
    b = warc.record("revisit", 2, "u", b"", 1000, warc.digest(b"x" * 1000), 1)
    for source in (warc.Plain(io.BytesIO(a + b)), warc.Members(io.BytesIO(warc.gzipped(a) + warc.gzipped(b)))):
        first = warc.fields(source.head())
        assert source.block(int(first["content-length"]), False) is None
        second = warc.columns_of(warc.fields(source.head()))
        assert (second["record_type"], second["page_id"], second["refers_to"], second["payload_bytes"]) == ("revisit", 2, 1, 1000)
        source.block(0, False)


def test_members_are_passed_over_by_their_length():
    """Unwanted members are sought past, not read; other tools unpack them; members that state no length run through."""
    import gzip
    import io

    bodies = [bytes(np.random.default_rng(k).integers(0, 256, 400_000, dtype=np.uint8)) for k in range(4)]
    records = [warc.record("response", k, "u", b, len(b), warc.digest(b), None) for k, b in enumerate(bodies)]
    packed = b"".join(map(warc.gzipped, records))
    assert gzip.decompress(packed) == b"".join(records)
    assert [warc.member_length(warc.gzipped(r)[:1024]) for r in records] == [len(warc.gzipped(r)) for r in records]

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            data = super().read(n)
            Counted.taken += len(data)
            return data

    for data, least, most in ((packed, 0, 5 * warc.READ_SIZE + 400_500), (b"".join(gzip.compress(r) for r in records), 1_600_000, 10**9)):
        Counted.taken, source, got = 0, warc.Members(Counted(data)), []
        for k in range(4):
            head = warc.fields(source.head())
            got.append(source.block(int(head["content-length"]), k == 2))
            assert warc.columns_of(head)["page_id"] == k
        assert source.head() is None and got[:2] == [None, None] and got[2].endswith(bodies[2])
        assert least <= Counted.taken <= most


def test_archives_equal_their_sql(spark, small, monkeypatch):
    import oracle
    from tidemerge.llm.queries import ORACLE, QUERIES

    monkeypatch.setitem(oracle.ORACLE, "op5_warc", ORACLE["op5_warc"])
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    assert oracle.difference(spark, oracle.connect(small), small, "op5_warc", QUERIES["op5_warc"](spark, small)) is None
    assert spark.conf.get(setting) == before


def test_no_pages_no_files(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived_pages(empty, f"file://{tmp_path}").count() == 0


# ------------------------------------------------------------------ vectors

ODD = [(9000, None), (9001, [0.0] * 16), (9002, [1.0] * 15 + [None]), (9003, [float("nan")] * 16), (9004, [float("inf")] + [1.0] * 15), (9005, []), (9006, [1.0, 2.0]), (None, [1.0] * 16)]


def vectors(spark, n=1200, d=16, seed=1):
    """Groups of near copies among strangers, exact copies and scaled copies."""
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, d))
    for start, size in ((0, 150), (200, 30), (300, 5)):
        x[start : start + size] = x[start] + draw.normal(size=(size, d)) * 0.05
    x[400:420] = x[400]
    x[420] = 3 * x[400]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    return x, spark.createDataFrame(rows + ODD, "vec_id long, embedding array<double>").withColumn("n_links", F.lit("x"))


def plain_links(x, threshold=0.95):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = u @ u.T >= threshold
    forest = Forest()
    for a, b in zip(*np.nonzero(np.triu(close, 1)), strict=True):
        forest.join(int(a), int(b))
    return close.sum(axis=1) - 1, [forest.root(i) for i in range(len(x))]


@pytest.mark.parametrize("shard", [100, 2048])
def test_near_duplicates_are_those_of_brute_force(spark, shard):
    x, df = vectors(spark)
    got = {r["vec_id"]: r for r in vector_graph.near_duplicates(df, shard=shard).collect() if r["vec_id"] is not None}
    links, group = plain_links(x)
    assert [got[i]["component_id"] for i in range(len(x))] == group
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.98 * links.sum()
    for i, _ in ODD:
        if i is not None:
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_a_link_found_in_any_shared_cluster_counts_once(spark, monkeypatch):
    """Classes 10 and 11 share clusters 3 and 5, 10 and 12 only 3: a link that one of the graphs misses is not lost, one that both find counts once."""
    import pandas as pd

    x = np.array([[1.0, 0.0], [1.0, 0.01], [1.0, -0.01], [0.0, 1.0]])
    shards = ([3, 5], [3, 5], [3, 7], [3, 9])

    def block(c, rows):
        return vector_graph._search_block(0.95)(pd.DataFrame({
            "c": c, "a": 0, "b": 0, "part": 0, "cls": [10 + r for r in rows], "n": [(1, 2, 1, 1)[r] for r in rows], "shards": [np.array(shards[r]) for r in rows],
            "x": [x[r].tobytes() for r in rows], "near": [[10 + o for o in rows if o != r] for r in rows], "medoid": [r == rows[0] for r in rows],
        }))

    def links(*blocks):
        plain = lambda v: [int(x) for x in v] if isinstance(v, np.ndarray) else None if v is None or pd.isna(v) else int(v)
        df = spark.createDataFrame([tuple(map(plain, r)) for b in blocks for r in b.itertuples(index=False)], vector_graph.FOUND)
        return {r["cls"]: r["links"] for r in vector_graph.counted(df).collect() if r["links"]}

    three, five = block(3, [0, 1, 2, 3]), block(5, [0, 1])
    assert links(three, five) == links(five, three) == links(three) == {10: 3, 11: 2, 12: 3}
    nothing = np.empty(0, np.int64)
    monkeypatch.setattr(vector_graph.Searcher, "within", lambda *_: (nothing, nothing))
    missed = block(3, [0, 1, 2, 3])
    assert links(missed, five) == {10: 2, 11: 1}


def test_near_duplicates_equal_their_sql(spark, small, tmp_path, monkeypatch):
    import oracle
    from tidemerge.llm.queries import ORACLE, QUERIES

    monkeypatch.setitem(oracle.ORACLE, "op7_embedding_near_dedup", ORACLE["op7_embedding_near_dedup"])
    x, df = vectors(spark, n=440)
    df.where("vec_id IS NOT NULL").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert oracle.difference(spark, con, str(tmp_path), "op7_embedding_near_dedup", QUERIES["op7_embedding_near_dedup"](spark, str(tmp_path))) is None
    assert oracle.difference(spark, oracle.connect(small), small, "op7_embedding_near_dedup", QUERIES["op7_embedding_near_dedup"](spark, small)) is None


@pytest.mark.parametrize("clusters", [2048, 4])
def test_links_come_from_graphs_of_many_clusters(spark, monkeypatch, clusters):
    """Several clusters, on one level and on two: nearly all links are found by graphs, without the exact way."""
    monkeypatch.setattr(vector_graph, "CLUSTERS", clusters)
    draw = np.random.default_rng(12)
    centres = draw.normal(size=(150, 24))
    x = np.concatenate([centres[i % 150] + draw.normal(size=24) * (0.02 if i % 3 else 0.3) for i in range(3000)]).reshape(3000, 24)
    monkeypatch.setattr(vector_graph, "_all_close", None)  # would fail if it were called
    classes = spark.createDataFrame([(i, 1, v) for i, v in enumerate(x.tolist())], "cls long, n long, x array<double>")
    found = vector_graph.linked(classes, len(x), shard=200)
    links, group = plain_links(x)
    got = {r["cls"]: r["links"] for r in found.collect() if r["links"]}
    assert sum(got.values()) >= 0.98 * links.sum() and all(got[i] <= links[i] for i in got)


def test_each_length_is_searched_apart(spark):
    draw = np.random.default_rng(13)
    wide, narrow = draw.normal(size=(60, 8)), draw.normal(size=(20, 3))
    wide[30:] = wide[:30] * 2
    narrow[10:] = narrow[:10] * 3
    rows = [(i, v) for i, v in enumerate([*wide.tolist(), *narrow.tolist()])] + [(200, [1.0]), (201, [5.0]), (202, [-1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_graph.near_duplicates(df).collect()}
    links, group = plain_links(wide)
    assert [got[i] for i in range(60)] == list(zip(links.tolist(), group, strict=True))
    links, group = plain_links(narrow)
    assert [got[60 + i] for i in range(20)] == [(n, 60 + g) for n, g in zip(links.tolist(), group, strict=True)]
    assert [got[i] for i in (200, 201, 202)] == [(1, 200), (1, 200), (0, 202)]
    near = {(r["query_id"], r["rank"]): r["vec_id"] for r in rp_forest.nearest(df, df.where("vec_id IN (0, 60, 200)")).collect()}
    assert near[0, 1] == 30 and near[60, 1] == 70 and [near[200, k] for k in (1, 2)] == [201, 202] and (200, 3) not in near


def test_classes_do_not_depend_on_partitions(spark):
    _, df = vectors(spark)
    one, many = (sorted(map(tuple, vector_graph.near_duplicates(df.repartition(k), shard=100).collect()), key=str) for k in (1, 9))
    assert one == many


@pytest.mark.parametrize("scale", [1e200, 1e-200, 5e-324])
def test_scores_of_extreme_magnitudes(spark, scale):
    """Squares of such components run over or under; the scores are those of the vectors scaled down."""
    draw = np.random.default_rng(14)
    x = draw.integers(1, 9, size=(40, 3)).astype(float)
    df = spark.createDataFrame([(i, (v * scale).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rp_forest.nearest(df, df).collect())
    assert len(got) == 200
    for q, rank, i, score in got:
        want = plain_nearest(x.tolist(), list(range(40)), q)
        assert score == pytest.approx(-want[rank - 1][0], abs=1e-12)
    links = {r["vec_id"]: r["n_links"] for r in vector_graph.near_duplicates(df).collect()}
    assert [links[i] for i in range(40)] == plain_links(x)[0].tolist()


def test_the_audit_sees_small_groups_lost_beside_a_large_one(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(400, 16))
    x[:150] = x[0] + draw.normal(size=(150, 16)) * 0.02
    x[200:220:2] = x[201:221:2] * 2
    links, _ = plain_links(x)
    classes = spark.createDataFrame([(i, 1, v) for i, v in enumerate(x.tolist())], "cls long, n long, x array<double>")
    full = [(i, int(k)) for i, k in enumerate(links) if k]
    made = lambda rows: spark.createDataFrame(rows, "cls long, links long")
    assert vector_graph.audit(classes, made(full), 0.95) == 1
    assert vector_graph.audit(classes, made(full[:150]), 0.95) < vector_graph.RECALL


def test_a_search_that_stays_below_the_bound_compares_all_pairs(spark, monkeypatch):
    """Whatever the graph misses: all links are there."""
    x, df = vectors(spark, n=440)
    monkeypatch.setattr(vector_graph, "audit", lambda *_: 0.0)
    got = {r["vec_id"]: r for r in vector_graph.near_duplicates(df.where("vec_id < 9000"), shard=100, overlap=12).collect()}
    links, group = plain_links(x)
    assert [got[i]["n_links"] for i in range(len(x))] == links.tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == group


def test_a_query_from_another_part_takes_the_widest_beam(monkeypatch):
    beams = []
    plain = vector_graph.Searcher.greedy
    monkeypatch.setattr(vector_graph.Searcher, "greedy", lambda self, q, own, beam: beams.append(beam) or plain(self, q, own, beam))
    x = np.random.default_rng(9).normal(size=(200, 8))
    graph = vector_graph.Searcher(vector_graph.unit(x), *vector_graph.build(vector_graph.unit(x)))
    graph.within(vector_graph.unit(x[:5]), np.full(5, -1), 0.95)
    assert beams == [vector_graph.BEAMS[-1]]


def test_no_usable_vectors(spark):
    df = spark.createDataFrame(ODD, "vec_id long, embedding array<double>")
    bad = df.where("vec_id IN (9000, 9001, 9002, 9003, 9004, 9005)")
    assert {tuple(r) for r in vector_graph.near_duplicates(bad).collect()} == {(i, 0, i, True) for i in range(9000, 9006)}
    assert rp_forest.nearest(bad, bad).count() == 0
    empty = df.where("false")
    assert vector_graph.near_duplicates(empty).count() == 0 and rp_forest.nearest(empty, empty).count() == 0


def test_pruning_keeps_no_neighbour_shadowed_by_a_kept_one():
    draw = np.random.default_rng(6)
    x = draw.normal(size=(60, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T
    order = np.argsort(-near, axis=1)[:, 1:]
    got = vector_graph.pruned(near, order, 60)
    away = np.sqrt(np.maximum(2 - 2 * near, 0))
    for i in range(60):
        kept = []
        for v in order[i]:
            if all(vector_graph.ALPHA * away[k, v] > away[i, v] for k in kept):
                kept.append(int(v))
        assert [v for v in got[i].tolist() if v >= 0] == kept


def plain_nearest(x, ids, q, k=5):
    cos = [(-math.fsum(a * b for a, b in zip(x[q], v)) / math.sqrt(math.fsum(a * a for a in x[q]) * math.fsum(b * b for b in v)), i) for i, v in zip(ids, x) if i != ids[q]]
    return sorted(cos)[:k]


@pytest.mark.parametrize(("leaf", "leaf_rows"), [(100, 64), (1024, 8192)])
def test_nearest_recall_scores_and_order(spark, leaf, leaf_rows):
    x, df = vectors(spark)
    got = rp_forest.nearest(df, df.where("vec_id % 50 = 0"), leaf=leaf, leaf_rows=leaf_rows).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == set(range(0, 1200, 50))
    hits = 0
    for q, rows in by.items():
        want = plain_nearest(x.tolist(), list(range(len(x))), q)
        hits += len({i for _, i in want} & {r["vec_id"] for r in rows})
        assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
        for r in rows:
            u, v = x[q], x[r["vec_id"]]
            assert abs(r["score"] - u @ v / np.sqrt((u @ u) * (v @ v))) < 1e-12
    assert hits >= 0.9 * 5 * len(by)
    assert [r["vec_id"] for r in by[400]] == [401, 402, 403, 404, 405]  # ties go to the smaller id


def test_fewer_candidates_than_wanted(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r)[:3] for r in rp_forest.nearest(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 7), (0, 2, 50), (50, 1, 7), (50, 2, 0)]


@pytest.mark.parametrize("other", [1.0, 0.999])
def test_repeated_rows_take_no_places(spark, other):
    """Every row five times, as it is or each copy a little apart: still five neighbours, those of brute force."""
    draw = np.random.default_rng(12)
    x = draw.normal(size=(60, 8))
    rows = [(i, [v[0] * other**c, *v[1:]]) for i, v in enumerate(x.tolist()) for c in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(i + 1000, v) for i, v in enumerate(x[:4].tolist())], "vec_id long, embedding array<double>")
    got = rp_forest.nearest(df, asked).collect()
    ids, held = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    truth = rp_forest.brute_force(rp_forest.usable(df), np.arange(4) + 1000, x[:4], 5).collect()
    for q in range(4):
        score = held @ x[q] / (np.linalg.norm(held, axis=1) * np.linalg.norm(x[q]))
        want = sorted(range(60), key=lambda i: (-score[ids == i].max(), i))[:5]
        for answer in (got, truth):
            assert [r["vec_id"] for r in sorted(answer, key=lambda r: r["rank"]) if r["query_id"] == q + 1000] == want


# ----------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, small, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, None, None), (None, "a text without id", "en", "s", 1), (3 * 10**6, "the fox and the dog went home. " * 30, "en", "s", 1), (2 * 10**6, "the fox and the dog went home. " * 30, "en", "s", 1)], docs.schema)
    docs = docs.union(extra)
    before, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "SimHash near-dedup", "PII", "mixing sources to target weights", "best-fit packing"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small)
        out.write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        ids = lambda df: {r[0] for r in df.select("doc_id").distinct().collect()}
        assert ids(after) <= ids(docs)
        if k < 4:
            assert after.columns == before
        if k == 1:
            assert 3 * 10**6 not in ids(after) or 2 * 10**6 not in ids(docs)
        if k in (2, 3, 4):
            assert ids(after) == ids(docs)
        docs = after
    labels = spark.read.parquet(f"{small}/labels.parquet")
    assert docs.count() and labels.count()


def test_pipeline_stages_equal_their_operators(spark, small):
    """Each stage by brute force: scores, groups, masks and rates of every document, one at a time."""
    import corpus_pipeline
    from test_texts import plain_keep_one
    from tidemerge.llm import mixing, packing, pii, quality, simhash

    stage = {n: f for n, f in corpus_pipeline.STAGES}
    docs = spark.read.parquet(f"{small}/documents.parquet").cache()
    rows = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    score = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, spark.read.parquet(f"{small}/labels.parquet")).collect()}
    good = stage["quality classifier"](spark, docs, small).cache()
    assert rows(good) == [r for r in rows(docs) if score[r[0]] >= quality.THRESHOLD]
    once = stage["SimHash near-dedup"](spark, good, small).cache()
    assert rows(once) == plain_keep_one(rows(good))
    masked = stage["PII"](spark, once, small).cache()
    tagger = pii.train()
    want = [(i, pii.masked(t, every)) for i, t in rows(once) for _, every in pii.all_spans([t or ""], tagger)]
    assert rows(masked) == sorted(want, key=str) and all(r["n_chars"] == len(r["text"]) for r in masked.collect())
    mixed = stage["mixing sources to target weights"](spark, masked, small).cache()
    rates = mixing.mixing_rates(masked, corpus_pipeline.languages(spark, masked, small), power=0.7, least=1.0).collect()
    text = dict(rows(masked))
    assert rows(mixed) == sorted([(r["doc_id"], text[r["doc_id"]]) for r in rates for _ in range(r["copies"])], key=str)
    packed = stage["best-fit packing"](spark, mixed, small)
    assert sorted(map(tuple, packed.collect()), key=str) == sorted(map(tuple, packing.pack_documents(mixed).collect()), key=str)


def test_pipeline_takes_odd_tables(spark, small, tmp_path):
    """Empty tables, and columns named like those the stages work with."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, df in {"documents": docs.limit(0), "labels": spark.read.parquet(f"{small}/labels.parquet").limit(0)}.items():
        df.write.parquet(f"{tmp_path}/empty/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
    odd = docs.limit(60).selectExpr("*", "1 AS _copy", "'x' AS fp", "doc_id AS component", "2 AS x", "text AS doc", "3 AS rate", "4 AS copies", "5 AS rank", "6 AS id")
    for _, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, odd, small)
        assert after.columns == odd.columns
        odd = spark.createDataFrame(after.collect(), after.schema)
    assert odd.count() and corpus_pipeline.STAGES[4][1](spark, odd, small).count()


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 14)} and "pipeline" in names
