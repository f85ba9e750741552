import __spark_entry__


def test_names_match():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries)
    assert {"p1_found", "block_name_topk"} <= set(queries)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["s1_id", "cand_id", "cand_source", "cos"]
