"""The generated test tables in the shape of the input contracts.

Every stand-in is a projection (or a join on keys) of whole test tables. Inbound and sales dates are moved
by ten years, so that they span the dates on which the business rules change.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOVED = "make_dt_interval(3652, CAST({hours} AS INT), 0, 0)"


def code(key: str) -> str:
    return f"lpad(CAST({key} AS STRING), 20, '0')"


def place(key: str) -> str:
    return f"lpad(CAST({key} % 5 + 1 AS STRING), 5, '0')"


def money(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(17,0)) / 100 AS DECIMAL(19,4))"


def cents(amount: str) -> str:
    return f"CAST(round({amount} * 100) AS BIGINT)"


FACTS = ("lineitem", "orders", "events")


class Standins:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A whole table; one that arrives in fewer splits than there are cores is dealt over the cores."""
        if name not in self._tables:
            df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            cores = self.spark.sparkContext.defaultParallelism
            if name in FACTS and df.rdd.getNumPartitions() < cores:
                df = df.repartition(cores)
            self._tables[name] = df
        return self._tables[name]

    # ---- catalogue ----

    @cached_property
    def product_master(self) -> DataFrame:
        return self.table("part").selectExpr(
            f"{code('p_partkey')} AS item_code",
            """CASE p_partkey % 11 WHEN 0 THEN 'IDAURORA' WHEN 1 THEN 'TEXASBKMNA' WHEN 2 THEN 'WHPBSUPPLY'
               WHEN 3 THEN 'IDTXBKSTAP' WHEN 4 THEN NULL WHEN 5 THEN 'TEXASBKNON' ELSE p_brand END
               AS purchase_from_vendor_id""",
            """CASE p_partkey % 13 WHEN 0 THEN 'IDWISHPETS' WHEN 1 THEN 'IDPOLLOCKP' WHEN 2 THEN NULL
               ELSE p_brand END AS vendor_id""",
            "CASE p_partkey % 17 WHEN 0 THEN 'HPBP' WHEN 1 THEN 'CHA' ELSE p_type END AS product_type",
            "CASE WHEN p_partkey % 19 = 0 THEN 'SUP' WHEN p_partkey % 19 < 4 THEN 'TTB' ELSE '' END AS user_char15",
            "CASE p_partkey % 23 WHEN 0 THEN 'BLANK' WHEN 1 THEN 'PLUSH' ELSE p_type END AS section_code",
            "timestamp_ntz'2001-12-31 12:00:00' - make_dt_interval(p_size * 20) AS create_date",
            f"CASE WHEN p_partkey % 10 = 8 THEN {code('p_partkey + 1')} END AS item_alias",
            f"{money(cents('p_retailprice'))} AS cost",
            "lpad(CAST(p_partkey AS STRING), 13, '0') AS isbn",
            f"{money(cents('p_retailprice'))} AS price",
        )

    @cached_property
    def product_master_dist(self) -> DataFrame:
        return self.table("part").selectExpr(
            f"{code('p_partkey')} AS item_code",
            f"""CASE p_partkey % 7 WHEN 0 THEN {code('greatest(p_partkey - 1, 0)')} WHEN 1 THEN ' '
                WHEN 3 THEN {code('p_partkey - 3')} END AS report_item_code""",
            f"CASE WHEN p_partkey % 3 > 0 THEN {code('p_partkey * 3')} END AS upc",
        )

    @cached_property
    def base_inventory(self) -> DataFrame:
        return self.table("part").filter("p_partkey % 97 = 0").selectExpr(f"{code('p_partkey')} AS item_code")

    @cached_property
    def overrides(self) -> DataFrame:
        """The largest parts are counted under the code before theirs; the largest of all report there."""
        return self.table("part").filter("p_size >= 49 AND p_partkey > 0").selectExpr(
            f"{code('p_partkey')} AS item_code",
            f"{code('p_partkey - 1')} AS new_item",
            f"CASE WHEN p_size = 50 THEN {code('p_partkey - 1')} END AS new_rpt_it",
        )

    @cached_property
    def items(self) -> DataFrame:
        """Followed items: all sections but one."""
        return self.table("part").filter("p_type <> 'MEDIUM'").selectExpr(
            f"{code('p_partkey')} AS item_code",
            f"{code('CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 1 ELSE p_partkey END')} AS item",
            "p_brand AS ri_vendor_id",
        )

    def catalogue(self, revised: bool) -> DataFrame:
        """The Items table before, or the incoming rows after, a revision of costs and vendors."""
        part = self.table("part")
        if not revised:
            part = part.filter("p_type <> 'PROMO'")
        cost = "p_retailprice * 2" if revised else "p_retailprice"
        vendor = "CASE WHEN p_size = 4 THEN NULL ELSE p_brand END" if revised else (
            "CASE WHEN p_size IN (5, 6) THEN NULL ELSE p_brand END"
        )
        stored = part.selectExpr(
            f"{code('p_partkey')} AS item_code",
            f"{code('p_partkey')} AS item",
            f"{code('p_partkey')} AS rpt_it",
            f"{vendor} AS ri_vendor_id",
            "p_type AS ri_section",
            f"{money(cents(f'CASE WHEN p_size < 3 THEN {cost} ELSE p_retailprice END'))} AS ic_cost",
            "lpad(CAST(p_partkey AS STRING), 13, '0') AS ri_isbn",
            "CAST(NULL AS STRING) AS ri_upc",
        )
        return stored if revised else stored.selectExpr("*", "timestamp_ntz'2010-01-01 06:00:00' AS last_update")

    @cached_property
    def known_codes(self) -> DataFrame:
        """Codes of a ledger kept before one section joined the population."""
        section = self.table("part").filter("p_type <> 'PROMO'").selectExpr("p_partkey AS l_partkey")
        return self.table("lineitem").join(section, "l_partkey", "left_semi").selectExpr(
            f"{code('l_partkey')} AS item_code"
        )

    # ---- inbound ----

    @cached_property
    def shipment_header(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "lpad(CAST(o_orderkey AS STRING), 10, '0') AS transfer_id",
            f"{place('o_custkey')} AS to_loc",
            "CASE WHEN o_orderkey % 9 = 7 THEN '00012' ELSE '00944' END AS from_loc",
            f"o_orderdate + {MOVED.format(hours='o_orderkey % 24')} AS date_received",
            "CASE WHEN o_orderkey % 4 = 1 THEN 1 ELSE 0 END AS drop_shipment",
        )

    @cached_property
    def shipment_detail(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "lpad(CAST(l_orderkey AS STRING), 10, '0') AS transfer_id",
            f"{code('l_partkey')} AS item_code",
            "l_orderkey + 500000 AS po_number",
            "CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS qty",
        )

    @cached_property
    def warehouse(self) -> list[tuple[DataFrame, DataFrame]]:
        """Live tables and two archives by year; the first archive overlaps the live tables."""
        order_types = """CASE o_orderpriority WHEN '1-URGENT' THEN 'HPB Assortment' WHEN '2-HIGH' THEN 'TTB REORDER'
            WHEN '3-MEDIUM' THEN 'WEBORDER' WHEN '4-NOT SPECIFIED' THEN 'TITLES' END"""
        orders = self.table("orders")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        spans = ("o_orderdate >= '2000-01-01'", "o_orderdate >= '1998-01-01' AND o_orderdate < '2000-07-01'",
                 "o_orderdate < '1998-01-01'")
        sources = []
        for span in spans:
            kept = orders.filter(span)
            detail = lines.join(kept, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
                "l_orderkey AS internal_shipment_num",
                "CAST(l_partkey AS STRING) AS item",
                "CAST(o_custkey % 5 + 1 AS STRING) AS ship_to",
                "CAST(l_quantity AS BIGINT) AS total_qty",
                f"{order_types} AS order_type",
            )
            header = kept.selectExpr(
                "o_orderkey AS internal_shipment_num",
                f"o_orderdate + {MOVED.format(hours='o_orderkey % 24')} AS actual_ship_ts",
            )
            sources.append((detail, header))
        return sources

    def _receipts(self, historical: bool) -> tuple[DataFrame, DataFrame]:
        span = "o_orderdate < '1998-01-01'" if historical else "o_orderdate >= '1998-01-01'"
        orders = self.table("orders").filter(span).filter("o_orderkey % 6 <> 0")
        started = f"o_orderdate + {MOVED.format(hours='o_orderkey % 24 + 48')}"
        header = orders.selectExpr(
            "o_orderkey AS batch_id",
            f"{place('o_custkey')} AS loc",
            """lpad(CAST(CASE WHEN o_orderkey % 4 = 1 THEN o_orderkey + 500000 ELSE o_orderkey END AS STRING), 10, '0')
               AS shipment_no""",
            "CASE WHEN o_orderkey % 4 = 1 THEN 'R' WHEN o_orderkey % 9 = 7 THEN 'S' ELSE 'W' END AS shipment_type",
            f"{started} AS process_start_ts",
        )
        lines = self.table("lineitem").filter("l_linenumber <> 5")
        detail = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
            "l_orderkey AS batch_id",
            f"{code('l_partkey')} AS item_code",
            "CAST(l_quantity AS BIGINT) - CASE WHEN l_linenumber = 4 THEN 1 ELSE 0 END AS qty",
            f"{started} + make_dt_interval(0, l_linenumber) AS process_ts",
        )
        return header, detail

    @cached_property
    def receipts(self) -> tuple[DataFrame, DataFrame]:
        return self._receipts(historical=False)

    @cached_property
    def receipts_hist(self) -> tuple[DataFrame, DataFrame]:
        return self._receipts(historical=True)

    @cached_property
    def cutoffs(self) -> DataFrame:
        """Locations with a drop-ship cutoff date; one has none, one has an open one."""
        return self.table("region").filter("r_regionkey < 4").selectExpr(
            f"{place('r_regionkey')} AS loc",
            "CASE WHEN r_regionkey < 3 THEN make_timestamp_ntz(2008 + r_regionkey, 1, 1, 0, 0, 0) END AS min_pon",
        )

    @cached_property
    def transit(self) -> DataFrame:
        """Median transit hours per location and origin."""
        places = self.table("region").selectExpr("r_regionkey", f"{place('r_regionkey')} AS loc")
        brands = self.table("part").select("p_brand").distinct()
        fixed = places.selectExpr(
            "loc",
            "explode(array(named_struct('xacn', 'CDC', 'vndr', 'any', 'hrs', 24), "
            "named_struct('xacn', 'StSi', 'vndr', '00012', 'hrs', 60))) AS t",
            "r_regionkey",
        ).selectExpr("loc", "t.xacn AS xacn", "t.vndr AS vndr", "t.hrs + r_regionkey AS mdn_transit_hrs")
        dropped = brands.selectExpr(
            "explode(sequence(0, 4)) AS r", "p_brand AS vndr"
        ).selectExpr(f"{place('r')} AS loc", "'Drps' AS xacn", "vndr", "length(vndr) * 10 + r AS mdn_transit_hrs")
        return fixed.unionByName(dropped)

    # ---- activity ----

    @cached_property
    def sales_item(self) -> DataFrame:
        ext = cents("l_extendedprice")
        return self.table("lineitem").filter(
            "l_returnflag = 'N' OR (l_returnflag = 'R' AND l_linestatus = 'F')"
        ).selectExpr(
            "concat('L', CAST(l_suppkey % 5 + 1 AS STRING)) AS location_id",
            "'S' AS xaction_type",
            "lpad(CAST(l_orderkey AS STRING), 10, '0') AS sales_xaction_id",
            f"l_shipdate + {MOVED.format(hours='0')} AS business_date",
            f"{code('l_partkey')} AS item_code",
            "CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN ' ' WHEN 3 THEN '7' ELSE '0' END AS sku_ext",
            "CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS is_return",
            "CAST(l_quantity AS BIGINT) AS quantity",
            f"{money(f'{ext} - ({ext} * CAST(round(l_discount * 100) AS BIGINT)) div 100')} AS register_price",
            f"{money(ext)} AS unit_price",
            f"{money(ext)} AS extended_amt",
            "CASE WHEN l_linenumber = 6 THEN 'V' ELSE 'A' END AS status",
        )

    @cached_property
    def sales_header(self) -> DataFrame:
        key = ["location_id", "xaction_type", "sales_xaction_id", "business_date"]
        return self.sales_item.select(*key).distinct().selectExpr(
            "*",
            "business_date + make_dt_interval(0, CAST(CAST(sales_xaction_id AS BIGINT) % 24 AS INT), "
            "CAST(CAST(sales_xaction_id AS BIGINT) % 60 AS INT)) AS end_date",
        )

    @cached_property
    def locations(self) -> DataFrame:
        return self.table("region").selectExpr(
            "concat('L', CAST(r_regionkey % 5 + 1 AS STRING)) AS location_id",
            f"{place('r_regionkey')} AS location_no",
            "CASE WHEN r_regionkey = 4 THEN 'I' ELSE 'A' END AS status",
        )

    @cached_property
    def facilities(self) -> DataFrame:
        return self.table("region").selectExpr(
            "concat('F', CAST(r_regionkey % 5 + 1 AS STRING)) AS facility_id", f"{place('r_regionkey')} AS location_no"
        )

    @cached_property
    def parts(self) -> int:
        return self.table("part").count()

    def _events(self, channel: int) -> DataFrame:
        paid = cents("value")
        return self.table("events").filter(f"user_id % 2 = {channel}").selectExpr(
            "event_id",
            "concat('F', CAST(user_id % 5 + 1 AS STRING)) AS facility_id",
            f"concat(CASE WHEN event_id % 10 = 9 THEN 'S' ELSE 'D' END, {code(f'event_id % {self.parts}')}) AS sku",
            "ts",
            "event_type",
            f"{paid} AS paid",
            f"CASE WHEN event_type = 'error' THEN ({paid} * (event_id % 4)) div 2 END AS refunded",
        )

    @cached_property
    def market_order(self) -> DataFrame:
        return self._events(0).selectExpr(
            "event_id AS order_id",
            "facility_id",
            "sku",
            "ts AS order_date",
            "CASE WHEN event_type = 'error' THEN ts + make_dt_interval(3) END AS refund_date",
            "paid % 3 AS shipped_qty",
            f"{money('paid')} AS price",
            f"{money('refunded')} AS refund_amount",
            f"{money('399')} AS shipping_fee",
            "CASE event_id % 5 WHEN 0 THEN 'New' WHEN 1 THEN 'Pending' WHEN 2 THEN 'Cancelled' ELSE 'Shipped' END "
            "AS order_status",
        )

    @cached_property
    def fulfil_header(self) -> DataFrame:
        return self.table("events").filter("event_id % 3 = 0").selectExpr(
            "event_id + 1000000 AS order_id",
            "event_id AS market_order_id",
            "CASE WHEN event_id % 6 = 3 THEN 'SAS' ELSE 'MON' END AS order_system",
        )

    @cached_property
    def fulfil_detail(self) -> DataFrame:
        return self.table("events").filter("event_id % 3 = 0").selectExpr(
            "event_id + 1000000 AS order_id",
            f"{place('event_id')} AS location_no",
            "CASE WHEN event_id % 2 = 0 THEN ' ' ELSE '2' END AS sku_ext",
            "event_id % 5 AS status",
            "CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 3 ELSE 0 END AS problem_status_id",
        )

    @cached_property
    def web_order(self) -> DataFrame:
        return self._events(1).selectExpr(
            "facility_id",
            "sku",
            "ts AS order_date",
            "ts + make_dt_interval(2) AS last_modified",
            "paid % 4 AS quantity",
            f"{money('paid')} AS item_price",
            f"{money('paid * (paid % 4)')} AS extended_amount",
            f"{money('499')} AS shipping_amount",
            f"{money('refunded')} AS item_refund_amount",
            "CASE WHEN event_id % 8 = 0 THEN 'canceled' ELSE 'done' END AS order_status",
            "CASE WHEN event_id % 7 = 0 THEN 'canceled' ELSE 'done' END AS item_status",
        )

    @cached_property
    def transfer_detail(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"{place('l_suppkey')} AS from_loc",
            f"{code('l_partkey')} AS item_code",
            f"l_shipdate + {MOVED.format(hours='l_orderkey % 24')} AS last_update",
            "l_linenumber + CASE WHEN l_discount > 0.085 THEN 7 ELSE 0 END AS transfer_type",
            "CAST(l_quantity AS BIGINT) AS quantity",
            "CASE WHEN l_returnflag = 'N' THEN 2 ELSE 3 END AS status_code",
            "CASE WHEN l_tax > 0.005 THEN 1 ELSE 0 END AS item_status",
        )

    def count_adjustment(self, centre: bool) -> DataFrame:
        return self.table("lineitem").filter(
            f"l_returnflag = 'R' AND l_linestatus = 'O' AND l_linenumber % 2 = {0 if centre else 1}"
        ).selectExpr(
            f"{place('l_suppkey')} AS loc",
            f"{code('l_partkey')} AS item_code",
            f"l_shipdate + {MOVED.format(hours='l_orderkey % 24')} AS trans_date",
            "CASE WHEN l_tax < 0.075 THEN CAST(l_quantity AS BIGINT) END AS new_qty",
        )

    # ---- ledger ----

    @cached_property
    def activity(self) -> DataFrame:
        """Every line as a ledger transaction, by flag and status."""
        return self.table("lineitem").selectExpr(
            f"{place('l_suppkey')} AS loc",
            f"{code('l_partkey')} AS item_code",
            "'0' AS sku_ext",
            "CASE WHEN l_returnflag = 'A' THEN concat('tid', lpad(CAST(l_orderkey AS STRING), 10, '0')) END AS shpmt",
            "l_shipdate + make_dt_interval(0, CAST(l_orderkey % 24 AS INT)) AS ts",
            """CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'CDC' WHEN l_returnflag = 'A' THEN 'Drps'
               WHEN l_returnflag = 'N' THEN 'Sale' WHEN l_linestatus = 'F' THEN 'Rtrn' ELSE 'SICC' END AS xacn""",
            """CASE WHEN l_returnflag = 'A' THEN 'in' WHEN l_returnflag = 'N' THEN 'out'
               WHEN l_linestatus = 'F' THEN 'in' ELSE 'set' END AS flow""",
            """CASE WHEN l_returnflag = 'N' THEN -CAST(l_quantity AS BIGINT)
               WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS qty""",
            "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) END AS inv",
            "CAST(NULL AS BIGINT) AS psh_qty",
            "CAST(NULL AS BIGINT) AS md_qty",
            "CAST(NULL AS DECIMAL(19,4)) AS sld_val",
            "CAST(NULL AS DECIMAL(19,4)) AS md_sld_val",
            "CAST(NULL AS DECIMAL(19,4)) AS sld_fee",
        )

    @cached_property
    def all_items(self) -> DataFrame:
        """Every part; codes ending in 9 are counted under the code before."""
        return self.table("part").selectExpr(
            f"{code('p_partkey')} AS item_code",
            f"{code('CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 1 ELSE p_partkey END')} AS item",
        )
