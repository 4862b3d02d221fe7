import hashlib

from quarryweave.queries import records
from tests.conftest import rows_of


def test_collisions_in_the_relationship_table(spark, tmp_path):
    rows = [("a", "bc"), ("ab", "c"), ("c", "ab"), ("d", "ef"), ("e", "fd"), ("x", "y"), ("y", "x"), ("z", "z"), ("a", None), (None, "bc")]
    spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "rel_no long, src_id string, tgt_id string").write.parquet(str(tmp_path / "custom_kg_relationships.parquet"))
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    got = rows_of(records.QUERIES["kg_pair_collisions"](spark, str(tmp_path)))
    assert got == [("a", "bc", md5("abc"), True, False), ("ab", "c", md5("abc"), True, False), ("e", "fd", md5("efd"), False, True)]
