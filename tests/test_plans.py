"""Plan shape: pruning, pushdown, and no full-row shuffle in validation."""

from rampart import RuleSpec, check_rules, validate
from rampart.plans import catalog
from rampart.sources.files import read_table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_and_filter_reach_the_scan(spark):
    df = read_table(spark, f"{SF}/orders.parquet", "parquet")
    p = plan(df.where("o_orderkey > 10").select("o_orderkey", "o_orderpriority"))
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,10)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in p


def test_validate_broadcasts_small_repeated_key_tables(spark):
    checked = validate(catalog._l0_orders(spark, SF), catalog._c("l0", "orders"))
    checked.write.format("noop").mode("overwrite").save()
    p = plan(checked)
    assert "SortMergeJoin" not in p
    assert p.count("BroadcastHashJoin") >= 3
    assert "SortAggregate" not in p  # keep-first rank is a plain long


def test_key_rule_reads_only_key_columns(spark):
    li = read_table(spark, f"{SF}/lineitem.parquet", "parquet", index=True)
    out = check_rules(li.select("l_orderkey", "l_linenumber", "_source_file", "_source_index"),
                      [RuleSpec("unique", ("l_orderkey", "l_linenumber"))])
    p = plan(out)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,_tmp_metadata_row_index:bigint>" in p


def test_one_plan_for_all_sizes(spark):
    """No branch on the input's size: only the planner's join choice differs."""
    import inspect

    from rampart.operators import load, validate as V
    from rampart.sources import files

    for module in (load, V, files):
        text = inspect.getsource(module)
        assert "getFileStatus(p).getLen" not in text and "FROM_BYTES" not in text


def test_input_is_evaluated_once_for_each_key_set(spark):
    orders = catalog._l0_orders(spark, SF)
    checked = validate(orders, catalog._c("l0", "orders"))
    p = checked._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("orders.parquet") <= orders._jdf.queryExecution().optimizedPlan().toString().count("orders.parquet")


def test_load_key_probe_is_range_pruned(spark, tmp_dir):
    from rampart import TableContract
    from rampart.operators import keysets
    from rampart.operators import load as L

    c = TableContract.from_dict({"table_name": "t", "columns": [
        {"name": "k", "type": "int", "primary_key": True}, {"name": "v", "type": "string"}]})
    root = f"{tmp_dir}/t"
    L.create_target(spark, c, root)
    L.append(spark, spark.range(0, 1000).selectExpr("id as k", "'x' as v"), c, root)
    target = L.read_target(spark, root, c)
    probe = keysets.in_range(target, spark.createDataFrame([(10,), (20,)], "k long"), [("k",)])
    p = plan(probe)
    assert "GreaterThanOrEqual(k,10)" in p and "LessThanOrEqual(k,20)" in p
    assert probe.count() == 11
