import random
import sqlite3
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarryweave import sources
from quarryweave.functions import checks
from quarryweave.functions.keys import entity_key
from quarryweave.operators import graph, knowledge, lookup, sections, selection
from quarryweave.sources import read_csv_manifest, read_jsonl_manifest
from tests.conftest import rows_of


def test_nodes_are_resolved_or_refused(spark):
    nodes = spark.createDataFrame([("n1", "Steel"), ("n2", "Steel"), ("n3", "Zinc"), ("n3", "Zinc"), ("n4", None), (None, "Lost")], "node string, label string")
    asked = spark.createDataFrame([("id", "n1"), ("id", "n9"), ("label", "Steel"), ("label", "Zinc"), ("label", "steel"), ("label", None), ("id", "n1"), ("label", "Lost")], "kind string, value string")
    assert rows_of(lookup.resolve_nodes(nodes, asked)) == sorted([("id", "n1", "match", "n1"), ("id", "n9", "unresolved", None), ("label", "Steel", "ambiguous", None), ("label", "Zinc", "match", "n3"), ("label", "steel", "unresolved", None), ("label", "Lost", "unresolved", None)], key=str)
    assert lookup.resolve_nodes(nodes.limit(0), asked.limit(0)).count() == 0


def test_search_takes_signs_as_they_are(spark):
    names = ["100% wool", "1000 wool", "a_b", "axb", "A_B fibre", None, "wool\\mix"]
    rows = spark.createDataFrame([(i, n, "M" if i % 2 else "P") for i, n in enumerate(names)], "no int, name string, kind string")
    found = lambda *a, **k: [(r["name"], r["more"]) for r in lookup.search_nodes(rows, "name", "no", *a, **k).collect()]
    assert found("0% w") == [("100% wool", False)] and found("A_B") == [("a_b", False), ("A_B fibre", False)]
    assert found("a_b", mode="exact") == [("a_b", False)] and found("\\") == [("wool\\mix", False)]
    assert found("wool", limit=2) == [("100% wool", True), ("1000 wool", True)] and found("wool", kind=("kind", "M")) == [("1000 wool", False)]


def test_entity_keys_and_types(spark):
    assert entity_key(" “Steel\0 Wire” ") == "steel wire" and entity_key("STRASSE") == entity_key("Straße") and entity_key("Ｎｉ　２") == "ni 2" and entity_key(None) is None and entity_key('"\'') == ""
    rows = spark.createDataFrame([(1, "k", "Process"), (2, "k", "Material"), (3, "k", "Mystery"), (4, "m", "Zzz"), (5, "m", "Other")], "no int, key string, kind string")
    assert rows_of(knowledge.most_common(rows, "key", "kind", "t", knowledge.type_rank(F.col("kind")))) == [("k", "Material"), ("m", "Other")]


def test_names_must_stand_in_their_fragments(spark):
    entities = spark.createDataFrame([(1, "Steel-Wire", "d", "f1"), (2, "copper", "d", "f1"), (3, "zinc", " ", "f1"), (4, None, "d", "f1"), (5, "x", "d", "f9"), (6, "—", "d", "f1"), (7, "Draht", "d", "f1"), (8, "x", "d", None)], "no int, name string, about string, frag string")
    fragments = spark.createDataFrame([("f1", "The STEEL wire held."), ("f1", "Der Draht riss."), ("f2", None), (None, "x")], "id string, text string")
    got = {r["row"]: r["outcome"] for r in knowledge.supported_mentions(entities, "no", "name", "about", "frag", fragments, "id", "text").collect()}
    assert got == {1: "kept", 2: "not_in_source", 3: "incomplete", 4: "incomplete", 5: "unknown_fragment", 6: "not_in_source", 7: "kept", 8: "unknown_fragment"}
    kept = spark.createDataFrame([("f1", "steel-wire"), ("f1", "draht"), ("f1", "draht")], "fragment string, key string")
    rels = spark.createDataFrame([(1, "Steel-wire", "DRAHT", "d", "f1"), (2, "Draht", "draht", "d", "f1"), (3, "zinc", "draht", "d", "f1"), (4, "draht", "zinc", "d", "f1"), (5, "draht", "steel-wire", None, "f1"), (6, "draht", "steel-wire", "d", "f2"), (7, None, "draht", "d", "f1")], "no int, l string, r string, about string, frag string")
    got = {r["row"]: r["outcome"] for r in knowledge.local_relationships(rels, "no", "l", "r", "about", "frag", kept).collect()}
    assert got == {1: "kept", 2: "self", 3: "no_source", 4: "no_target", 5: "incomplete", 6: "no_source", 7: "no_source"}


def brute_selection(candidates, most, budget):
    taken, pages = [], 0
    for source, n in candidates:
        if len(taken) < most and pages + n <= budget:
            taken.append(source)
            pages += n
    return set(taken)


SOURCE = "source string, root string, path string, title string, kind string, doi string, digest string, canonical string, status string, metadata map<string,string>"


@pytest.mark.parametrize("most, budget", [(20, 2000), (3, 160), (50, 777)])
def test_selection_within_a_budget(spark, most, budget):
    rng = random.Random(most)
    rows = [(f"s{i:03d}", "main" if i % 3 else "other", "p", " ".join(rng.choice(["steel", "wire", "zinc"]) for _ in range(rng.randint(1, 6))), "book", None, None, None, "new", {"page_count": str(rng.randint(1, 400))} if i % 4 else {}) for i in range(80)]
    out = {r["source"]: r for r in selection.select_for_gap(selection.rejections(spark.createDataFrame(rows, SOURCE), ["done"], ["failed"], "main"), "Steel wire", most, budget).collect()}
    score = lambda r: r[3].split().count("steel") + r[3].split().count("wire")
    order = sorted(rows, key=lambda r: (-score(r), r[1] != "main", r[0]))
    assert [out[r[0]]["rank"] for r in order] == list(range(1, 81))
    assert {s for s, r in out.items() if r["selected"]} == brute_selection([(r[0], int(r[9].get("page_count", 100))) for r in order], most, budget)


def test_rejected_sources(spark):
    rows = [
        ("a", "main", "p", "Steel wire", "book", None, "d1", None, "done", {}), ("b", "main", "p", "Steel wire again", "book", None, "d1", None, "new", {}),
        ("c", "other", "p", "Zinc", "book", None, "d2", None, "new", {}), ("d", "main", "p", "Zinc", "book", None, "d2", None, "new", {}), ("e", "main", "p", "Zinc", "book", None, None, "a", "new", {}),
        ("f", "main", "p", "Untitled", "book", None, None, None, "new", {}), ("g", "main", "p", None, "book", "10.1/x", None, None, "new", {}), ("h", "main", "p", " ", "book", None, None, None, "new", {"authors": "Li"}),
        ("i", "main", "p", "Old", "book", None, None, None, "failed", {}), ("j", "main", "p", "Short", "book", None, None, None, "new", {}), ("j", "main", "p", "Much longer title", "book", None, "d1", None, "new", {}),
        (None, "main", "p", "No id", "book", None, None, None, "new", {}), ("k", "main", "p", "Null map", "book", None, None, None, "new", None),
    ]
    got = {r["source"]: (r["reason"], r["pages"]) for r in selection.rejections(spark.createDataFrame(rows + rows[:2], SOURCE), ["done"], ["failed"], "main").collect()}
    assert got == {"a": ("duplicate", 100), "b": ("duplicate", 100), "c": ("duplicate", 100), "d": (None, 100), "e": ("duplicate", 100), "f": ("insufficient_metadata", 100), "g": (None, 100), "h": (None, 100), "i": ("insufficient_metadata", 100), "j": ("duplicate", 100), "k": (None, 100)}
    judged = selection.rejections(spark.createDataFrame([], SOURCE), ["done"], [], "main")
    assert selection.select_for_gap(judged, "steel").count() == 0


def test_blocks_with_page_and_section(spark):
    text = "# The Title\n\n> 来源: scan\nIntro line one\nline two\r\n<!-- PAGE 3 -->\n\n## Section A ##\ntext a\n![x](y.png)\nmore a\n# 第 4 页\n---\nafter\n[Blank Page]\n# The title\nend"
    df = spark.createDataFrame([(1, text, "The title"), (2, None, "x"), (3, "", "x")], "no int, text string, title string").withColumn("kind", F.lit(1)).withColumn("line", F.lit(2))
    got = [tuple(r) for r in sections.text_blocks(df, "no", "text", "title").drop("path").orderBy("row", "block_no").collect()]
    assert got == [
        (1, 1, None, None, "text", "Intro line one\nline two"), (1, 2, 3, "Section A", "heading", "Section A"), (1, 3, 3, "Section A", "text", "text a"), (1, 4, 3, "Section A", "text", "more a"),
        (1, 5, 4, "Section A", "text", "after"), (1, 6, 4, "The title", "heading", "The title"), (1, 7, 4, "The title", "text", "end"),
    ]
    assert sections.text_blocks(df.limit(0), "no", "text", "title").count() == 0


def test_repeated_fields_are_problems(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"Title": "a", "title": "b", "path": "x"}\n{"Byte Size": 3, "path": "y"}\n{"ｐａｔｈ": "z"}\n{}\n')
    got = {(r["relative_path"], r["byte_size"], r["problem"]) for r in read_jsonl_manifest(spark, str(tmp_path / "m.jsonl")).collect()}
    assert got == {(None, None, "repeated field"), ("y", 3, None), ("z", None, None), (None, None, "no path")}
    (tmp_path / "m.csv").write_text("Path,path\na,b\n")
    assert [r["problem"] for r in read_csv_manifest(spark, str(tmp_path / "m.csv")).collect()] == ["repeated field"]


def test_modularity_and_attachment(spark):
    cliques = [[f"a{i}" for i in range(4)], [f"b{i}" for i in range(4)]]
    pairs = [(x, y, 2) for c in cliques for i, x in enumerate(c) for y in c[i + 1 :]] + [("a0", "b0", 1), ("b1", "c0", 3), ("a1", "c0", 1), ("d0", "d1", 1)]
    df = spark.createDataFrame(pairs, "a string, b string, weight long")
    groups = {n: n[0] for p in pairs for n in p[:2]}
    table = spark.createDataFrame(list(groups.items()), "node string, community string")
    total, degree, inside = sum(w for *_, w in pairs), defaultdict(int), 0
    for a, b, w in pairs:
        degree[groups[a]] += w
        degree[groups[b]] += w
        inside += w * (groups[a] == groups[b])
    want = inside / total - sum((d / (2 * total)) ** 2 for d in degree.values())
    got = graph.modularity(df, table, "node", "community").first()
    assert got["groups"] == 4 and got["modularity"] == pytest.approx(want)
    attached = dict(map(tuple, graph.attach_small(df, table, 3).collect()))
    assert attached == groups | {"c0": "b"}
    numbered = {r["node"]: r["number"] for r in graph.ordered_groups(spark.createDataFrame(list(attached.items()), "node string, community string")).collect()}
    assert numbered["b0"] == numbered["c0"] == 0 and numbered["a3"] == 1 and numbered["d1"] == 2


def test_paths_of_sections(spark):
    text = "# A\na\n### C\nc\n## B\nb\n# D\nd\n## E\ne"
    got = [(r["body"], r["path"]) for r in sections.text_blocks(spark.createDataFrame([(1, text, "x")], "no int, text string, title string"), "no", "text", "title").filter("kind = 'text'").orderBy("block_no").collect()]
    assert got == [("a", "A"), ("c", "A / C"), ("b", "A / B"), ("d", "D"), ("e", "D / E")]


def test_checks(spark):
    paths = {"a/b.md": "a/b.md", "./a//b/": "a/b", "a\\b": "a/b", "/a": None, "C:\\x": None, "http://x/y": None, "a/../b": None, "..": None, " ": None, "a..b": "a..b", None: None}
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").select(checks.relative_path(F.col("p"))).collect()]
    assert got == list(paths.values())
    texts = {"key sk-abcdefghijklmnop1": (True, False), "Bearer abcdefghijklmnopqrst": (True, False), "eyJhbGciOiJI.abcdefghij.klmnopqrst": (True, False), "see \\\\nas01\\share": (False, True), "at D:/data": (False, True), "smb://host/x": (False, True), "ratio 3:1 and a:b": (False, False)}
    got = [tuple(r) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").rlike(checks.SECRET), F.col("t").rlike(checks.INTERNAL_PLACE)).collect()]
    assert got == list(texts.values())
    one = spark.range(1).select(checks.bounded_label(F.lit("a  b\tcdef"), 5).alias("a"), checks.type_pair(F.lit("Z"), F.lit(None).cast("string")).alias("b"), checks.mention_weight(F.lit(0)).alias("c"), checks.rgb(F.lit("#0aFf10")).alias("d"), checks.rgb(F.lit("red")).alias("e")).first()
    assert tuple(one) == ("a b …", "Other|Z", 1.0, [10, 255, 16], None)


def test_bundles_are_whole_or_refused(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b", None), (1, "ä", [1, 2]), (1, "ä", [1, 2])], "no int, name string, x array<int>")
    path = f"file://{tmp_path}/bundle"
    sources.write_bundle({"rows": (rows, ["no"]), "none": (rows.limit(0), ["no"])}, path, generation="g1")
    back = sources.read_bundle(spark, path, ["rows", "none"])
    assert sorted(map(str, back["rows"].collect())) == sorted(map(str, rows.collect())) and back["none"].count() == 0
    assert sources.table_digest(rows.repartition(3)).first() == sources.table_digest(rows.coalesce(1)).first()
    with pytest.raises(ValueError):
        sources.read_bundle(spark, path, ["rows"])
    rows.limit(1).write.mode("overwrite").json(f"{path}/rows.jsonl")
    with pytest.raises(ValueError):
        sources.read_bundle(spark, path)


def test_sqlite_in_parts(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "x.db")
    db.execute("create table node (id integer primary key, name text)")
    db.executemany("insert into node values (?, ?)", [(i * 3, f"n{i}") for i in range(50)])
    db.commit()
    assert rows_of(sources.read_sqlite(spark, str(tmp_path / "x.db"), "node", "id long, name string", parts=4)) == [(i * 3, f"n{i}") for i in range(50)]
    for table, schema in (("node", "id long, kind string"), ("node; drop", "id long")):
        with pytest.raises(ValueError):
            sources.read_sqlite(spark, str(tmp_path / "x.db"), table, schema)
