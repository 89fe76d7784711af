"""Tables that grow with the catalogue are not broadcast, however small they are on disk."""

from shelfbook.operators import items


def plan(df):
    """The plan as it was run; joins may have changed at run time."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_enriching_joins_long_tables_by_merging(spark):
    master = spark.createDataFrame(
        [("a", "1.0", "v", None, " s ", "i", "b"), ("b", "2.0", None, "w", "t", "j", None)],
        "item_code string, cost string, purchase_from_vendor_id string, vendor_id string, section_code string, isbn string, item_alias string",
    )
    dist = spark.createDataFrame([("a", "u"), ("b", None)], "item_code string, upc string")
    links = items.repair_parent(spark.createDataFrame([("a", "b"), ("b", "b")], "item_code string, rpt_it string"))
    found = items.enrich_items(links.selectExpr("item_code", "item_code AS item", "rpt_it"), master, dist)
    assert "Broadcast" not in plan(found)
    assert sorted((r.item_code, r.rpt_it, r.ri_vendor_id, r.ic_cost, r.ri_section) for r in found.collect()) == [
        ("a", "b", "w", "1.0", "t"), ("b", "b", "w", "2.0", "t")
    ]
