import datetime as dt
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from quarryweave.functions.dois import doi_key
from quarryweave.functions.keys import canonical_uuid, normal_name
from quarryweave.operators import catalog, graph, knowledge, retrieval, texts
from quarryweave.operators.orphans import hot_keys, orphan_references
from tests.conftest import rows_of

DAY = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
CHILD = "ref_table string, ref_field string, ref_row long, ref_key string, parent_table string, at timestamp"
PARENT = "parent_table string, key string, born timestamp, died timestamp, part int"


def test_normal_names():
    assert normal_name(' "Steel  Wire" \n') == "steel wire"
    assert normal_name("Ｓｔｅｅｌ　ｗｉｒｅ") == "steel wire"
    assert normal_name("'“x”'") == "x" and normal_name("") == "" and normal_name(None) is None and normal_name('"') == '"'


def test_dois_and_uuids(spark):
    spelled = ["https://doi.org/10.1234/AB.c", "doi:10.1234/ab.c", "<10.1234/ab.c>", "10.1234%2Fab.c.", " １0.1234/ab.c ", "10.1234/unknown", "10.99/xxxx", "10.1234/xxxx", "n/a", "", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in spelled], "d string").select(doi_key(F.col("d"))).collect()]
    assert got == ["10.1234/ab.c"] * 5 + [None] * 6
    brackets = {"10.1016/S0022-1996(02)": "10.1016/s0022-1996(02)", "(10.1016/s1(02)).": "10.1016/s1(02)", "10.1/x": None, "10.1234/a[1]];": "10.1234/a[1]", "10.1234/a(b(c))": "10.1234/a(b(c))", "10.1234/a(b.": "10.1234/a(b"}
    got = [r[0] for r in spark.createDataFrame([(x,) for x in brackets], "d string").select(doi_key(F.col("d"))).collect()]
    assert got == list(brackets.values())
    one = uuid.uuid4()
    forms = [str(one), "{" + str(one).upper() + "}", f"urn:uuid:{one}", f" {one}\n", one.hex, None, " ", "not an id"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in forms], "d string").select(canonical_uuid(F.col("d"))).collect()]
    assert got == [str(one)] * 5 + [None, None, "notanid"]


def brute_orphans(children, parents):
    out = set()
    for table, field, row, key, parent, at in children:
        if key is None:
            continue
        lives = [(b, d) for p, k, b, d in parents if p == parent and k is not None and normal_name(k) == normal_name(key)]
        if not lives:
            out.add((table, field, row, key, "missing"))
        elif at is not None and not any((b is None or b <= at) and (d is None or at < d) for b, d in lives):
            out.add((table, field, row, key, "late" if all(b is not None and b > at for b, _ in lives) else "deleted"))
    return out


def test_orphans_against_brute_force(spark):
    rng = random.Random(3)
    names = ["Alpha", "beta ", "ＧＡＭＭＡ", "'delta'", "eps", "", "gone"]
    parents = [("name", rng.choice(names[:5] + [None]), rng.choice(DAY[:30] + [None]), None if rng.random() < 0.4 else rng.choice(DAY), ) for _ in range(12)]
    children = [("rel", rng.choice(["src", "tgt"]), i, rng.choice(["alpha", "BETA", "gamma", "delta", "eps", "", "nobody", None]), "name", rng.choice(DAY + [None])) for i in range(400)]
    children += children[:20] + [("rel", "src", 1000 + i, "alpha", "name", DAY[i % 40]) for i in range(60_000)]
    got = orphan_references(spark.createDataFrame(children, CHILD), spark.createDataFrame([(*p, 7) for p in parents] * 2, PARENT)).drop("at")
    assert set(map(tuple, got.collect())) == brute_orphans(children, parents)
    assert got.count() == len(brute_orphans(children, parents))


def test_a_key_in_many_spellings_is_hot(spark):
    # one key in 1,000 spellings, none of them frequent by itself, holds most references
    spelled = ["".join(c.upper() if i >> k & 1 else c for k, c in enumerate("conductivity")) for i in range(1000)]
    rows = spark.range(120_000).select(F.lit("rel").alias("ref_table"), F.lit("src").alias("ref_field"), F.col("id").alias("ref_row"), F.element_at(F.array(*map(F.lit, spelled)), (F.col("id") % 1000 + 1).cast("int")).alias("ref_key"), F.lit("name").alias("parent_table"), F.lit(DAY[3]).alias("at"))
    got = orphan_references(rows, spark.createDataFrame([("name", "Conductivity", DAY[5], None, 0)], PARENT))
    assert got.groupBy("reason").count().collect() == [("late", 120_000)]
    parts = [r["parts"] for r in hot_keys(rows.withColumn("key", F.lower("ref_key"))).collect()]
    assert parts == [512]


def test_orphans_of_empty_tables(spark):
    no_children, no_parents = spark.createDataFrame([], CHILD), spark.createDataFrame([], PARENT)
    assert orphan_references(no_children, no_parents).count() == 0
    assert rows_of(orphan_references(spark.createDataFrame([("t", "f", 1, "x", "name", None)], CHILD), no_parents).drop("at")) == [("t", "f", 1, "x", "missing")]


def test_graph_against_brute_force(spark):
    rng = random.Random(5)
    names = [f"n{i:02d}" for i in range(40)]
    rows = [(rng.choice(names[:30]), rng.choice(names[:30] + ["lost"])) for _ in range(28)] + [("n00", "n00"), ("n01", None)]
    nodes, edges = spark.createDataFrame([(n,) for n in names], "node string"), spark.createDataFrame(rows, "l string, r string")
    known = set(names)
    degree = {n: 0 for n in names}
    for a, b in rows:
        if a in known and b in known:
            degree[a] += 1
            degree[b] += 1
    assert dict(map(tuple, graph.degrees(nodes, edges, "l", "r").collect())) == degree
    one = graph.audit(nodes, edges, "l", "r").first()
    assert one["entities"] == 40 and one["self_loops"] == sum(a == b and a in known for a, b in rows) and one["distinct_pairs"] == len(set(rows)) and one["repeated_rows"] == len(rows) - len(set(rows)) and one["isolated"] == sum(d == 0 for d in degree.values())
    pairs = graph.undirected(edges.filter("r is not null and r <> 'lost'"), "l", "r")
    label = {n: n for n in names}
    for _ in names:
        for a, b in rows:
            if a in known and b in known:
                label[a] = label[b] = min(label[a], label[b])
    assert dict(map(tuple, graph.components(nodes, pairs).collect())) == label
    ranks = graph.pagerank(nodes, edges, "l", "r", rounds=12)
    assert ranks.agg(F.sum("rank")).first()[0] == pytest.approx(1.0)
    groups = dict(map(tuple, graph.communities(nodes, pairs).collect()))
    assert set(groups) == known and all(label[groups[n]] == label[n] for n in names)
    near = {r["node"]: r["hop"] for r in graph.neighbourhood(pairs, spark.createDataFrame([("n03",)], "node string"), 2).collect()}
    links = {(a, b) for a, b in rows if a in known and b in known} | {(b, a) for a, b in rows if a in known and b in known}
    hop1 = {b for a, b in links if a == "n03"} - {"n03"}
    hop2 = {b for a, b in links if a in hop1} - hop1 - {"n03"}
    assert near == {"n03": 0, **{n: 1 for n in hop1}, **{n: 2 for n in hop2}}


def test_graph_of_nothing(spark):
    nodes, pairs = spark.createDataFrame([], "node string"), spark.createDataFrame([], "a string, b string, weight long")
    assert graph.components(nodes, pairs).count() == 0 and graph.pagerank(nodes, pairs, "a", "b", rounds=2).count() == 0


def test_catalog(spark):
    rows = [(1, "r", "a/b.pdf", None, "unknown"), (2, "r", "a/b.pdf", 5, "granted"), (3, "r", "a/b.pdf", None, "unknown"), (4, "r", "c", None, None)]
    df = spark.createDataFrame(rows, "no long, root string, path string, size long, legal string")
    ids = {r["no"]: r["u"] for r in df.select("no", catalog.uuid5(F.concat_ws(":", F.lit("x"), "root", "path")).alias("u")).collect()}
    assert ids[1] == str(uuid.uuid5(uuid.NAMESPACE_URL, "x:r:a/b.pdf"))
    merged = rows_of(catalog.merge_preferred(df, ["root", "path"], [F.col("no")], ["size", "legal"], {"legal": ["unknown"]}))
    assert merged == [("r", "a/b.pdf", 5, "granted"), ("r", "c", None, None)]
    copies = catalog.canonical_copies(df.withColumn("sha", F.lit("s")), "no", "sha", ["size"], F.lit(False))
    assert rows_of(copies) == [(1, 2), (2, 2), (3, 2), (4, 2)]


def test_knowledge(spark):
    rows = [(1, "k", "Name", "T", "d one", "s1"), (2, "k", "NAME", "T", "d two", "s2"), (3, "k", "NAME", "U", None, "s1"), (4, None, "x", "T", "d", "s"), (5, "e", None, None, " ", None)]
    df = spark.createDataFrame(rows, "no long, key string, name string, kind string, descr string, src string")
    got = {r["key"]: r for r in knowledge.canonical_entities(df, "key", "name", "kind", "descr", "src", "no").collect()}
    assert got["k"]["mentions"] == 3 and got["k"]["display_name"] == "NAME" and got["k"]["entity_type"] == "T" and got["k"]["sources"] == ["s1", "s2"]
    assert got["k"]["description"] == "d one；d two" and got["e"]["description"] is None and set(got) == {"k", "e"}
    rel = spark.createDataFrame([("b", "a", "x"), ("a", "b", "y"), ("a", "a", "z"), (None, "a", "w")], "l string, r string, d string")
    assert [r["mentions"] for r in knowledge.canonical_relationships(rel, "l", "r", "d").collect()] == [2]
    clash = spark.createDataFrame([("ab", "c"), ("a", "bc")], "l string, r string")
    assert {r["concat_collision"] for r in knowledge.pair_collisions(clash, "l", "r").collect()} == {True}


def test_retrieval(spark):
    ranked = spark.createDataFrame([("q", i, i, c) for i, c in enumerate([50, 60, 30, 20, 5], 1)], "g string, item long, rank int, cost long")
    got = {r["item"]: r["selected"] for r in retrieval.within_budget(ranked, "g", "item", "rank", "cost", 3, 100).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: False}
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None)], "i long, v array<double>")
    top = retrieval.cosine_top(vectors.filter("i = 1"), "i", "v", vectors.select(F.col("i").alias("item"), "v"), "item", "v", 2)
    assert [(r["item"], r["rank"]) for r in top.orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_texts(spark):
    df = spark.createDataFrame([("One. Two! 三。四",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(texts.sentence_units(F.col("t"))).collect()] == [["One.", "Two!", "三。", "四"], [], []]
    assert df.select(texts.search_tokens(F.col("t"))).first()[0] == ["one", "two", "三", "四"]
    chunks = texts.chunk_text("Sentence number one. " * 40, 100, 140, 20)
    assert all(len(c) <= 140 for c in chunks) and len(chunks) > 5 and texts.chunk_text("x" * 950, 100, 140, 20)[0] == "x" * 100
    assert texts.chunk_documents(df.withColumn("n", F.lit(1)), "n", "t", 20, 40, 5).count() == 1


def test_manifests(spark, tmp_path):
    from quarryweave.sources import read_csv_manifest, read_jsonl_manifest, write_edge_pairs, write_jsonl, write_vectors

    lines = [json.dumps({"Path": "a/b.pdf", "DOI": "doi:10.1234/Q", "size": "12", "colour": "red"}), "", "not json", '{"path": "a", "path": "b"}', json.dumps({"title": "no path"}), "[1]"]
    (tmp_path / "m.jsonl").write_text("\n".join(lines))
    got = read_jsonl_manifest(spark, str(tmp_path / "m.jsonl")).collect()
    good = [r for r in got if r["problem"] is None]
    assert len(got) == 5 and len(good) == 1 and good[0]["normalized_doi"] == "10.1234/q" and good[0]["byte_size"] == 12 and good[0]["metadata"] == {"colour": "red"} and good[0]["display_title"] == "b.pdf"
    (tmp_path / "m.csv").write_text('path,title,extra\na.pdf,"two\nlines",1\nb.pdf,x\n')
    rows = read_csv_manifest(spark, str(tmp_path / "m.csv")).collect()
    assert {(r["relative_path"], r["problem"]) for r in rows} == {("a.pdf", None), ("b.pdf", "field count")}
    df = spark.createDataFrame([(2, None, [1.0, 0.5]), (1, "x", [0.0, 2.0])], "n int, s string, v array<float>")
    write_jsonl(df, str(tmp_path / "out"), ["n"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert [json.loads(x)["n"] for x in text.splitlines()] == [1, 2] and '"s":null' in text
    write_vectors(df, str(tmp_path / "vec"), "n", "v")
    assert sum(p.stat().st_size for p in (tmp_path / "vec").glob("part-*.bin")) == 8
    write_edge_pairs(df.select("n", F.col("n").alias("m")), str(tmp_path / "edges"), "n", "m")
    assert sum(p.stat().st_size for p in (tmp_path / "edges").glob("part-*.bin")) == 16


def test_manifest_stream_replays_add_nothing(spark, tmp_path):
    from quarryweave.streaming import ingest_manifest_stream

    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    (folder / "1.jsonl").write_text('{"path": "a", "size": 1}\n{"path": "a", "size": 1}\nbad\n')
    for extra in (None, '{"path": "a", "size": 1}\n{"path": "a", "size": 2}\n', None):
        if extra:
            (folder / "2.jsonl").write_text(extra)
        ingest_manifest_stream(spark, str(folder), table, str(tmp_path / "check"), "root").awaitTermination()
    assert spark.read.parquet(table).count() == 2


def test_streams_equal_batches(spark, tmp_path):
    from quarryweave.streaming import quota_windows, quota_windows_stream, streaks_stream

    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=20 * i), f"u{i % 2}", 1.0) for i in range(30)]
    rows.append((99, dt.datetime(2024, 1, 2), "u0", 1.0))
    batch = spark.createDataFrame(rows, "event long, ts timestamp, scope string, value double")
    batch.write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "events"))
    query = quota_windows_stream(stream, "ts", "scope", "value").writeStream.format("memory").queryName("quotas").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    want = [r for r in rows_of(quota_windows(batch, "ts", "scope", "value")) if r[1] < dt.datetime(2024, 1, 2)]
    assert rows_of(spark.table("quotas")) == want
    events = stream.select("scope", F.col("ts").alias("at"), "event", F.lit("ok").alias("outcome"))
    query = streaks_stream(events).writeStream.format("memory").queryName("streaks").outputMode("update").start()
    query.processAllAvailable()
    query.stop()
    assert rows_of(spark.table("streaks")) == [("u0", "ok", 16), ("u1", "ok", 15)]
