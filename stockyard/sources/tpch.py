"""The supplied order/lineitem tables seen as the thirteen-table model (see FIXTURES.md).

Every formula is a function of one source row wherever the model allows it, so the mapping adds
no join and at most one shuffle (line numbering) to a plan, and none where the line id is unused.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.dataset import Dataset
from stockyard.operators.ledger import derive_movements, movement_code
from stockyard.session import require_conf, shared_folder

AS_OF = datetime(2001, 8, 2)
WAREHOUSES = 25

# Declared, never inferred: inference would run one job for each read.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

HEAD_TITLE = "Site Head"
JOB_TITLES = ("Stock Keeper", "Truck Loader", "Dock Planner", "Goods Inspector", "Route Analyst", "Floor Lead", "Order Packer")


# A category id is spelled by the first two letters of the type, a child's also by the brand number.
ROOT_CATEGORY = "cast(ascii(p_type) * 100 + ascii(substr(p_type, 2)) as bigint)"
CHILD_CATEGORY = f"{ROOT_CATEGORY} * 1000 + cast(substr(p_brand, 7) as bigint)"
FOUNDED = "timestamp_ntz '1995-01-01 00:00:00'"
# Lines are numbered inside parts of their order, more of them where the largest order needs it, so that a huge order is
# many window groups. An id is (order, part, place) with room for the fullest part: ids cannot meet, and one that
# outgrows 64 bits is an error.
LINES_PER_PART, LEAST_PARTS = 65_536, 64
LINE_MARK = "l_partkey + l_suppkey + l_linenumber + cast(l_quantity as bigint)"
LINE_ORDER = (
    "l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()


def load_tpch(spark: SparkSession, path: str, as_of: datetime = AS_OF) -> Dataset:
    require_conf(spark)
    return _Mapping(spark, path.rstrip("/")).dataset(as_of)


_NUMBERED: WeakKeyDictionary[Dataset, Dataset] = WeakKeyDictionary()


def with_stored_lines(ds: Dataset) -> Dataset:
    """The tables of ``ds.origin`` over lines that are numbered and stored once for each dataset.

    For plans that read ids of lines more than once, directly or by the ledger. The tables are those ``load_tpch`` gives.
    """
    if ds not in _NUMBERED:
        mapping = _Mapping(ds.spark, ds.origin)
        mapping.store_lines()
        _NUMBERED[ds] = mapping.dataset(ds.as_of)
    return _NUMBERED[ds]


def _with_ids(placed: DataFrame, room: DataFrame) -> DataFrame:
    line_id = (F.col("l_orderkey") * F.col("parts") + F.col("part")) * room.scalar() + F.col("place") - 1
    return placed.withColumn("line_id", line_id).selectExpr(
        "line_id",
        "l_orderkey",
        "l_orderkey + 1 as order_id",
        "l_partkey + 1 as product_id",
        "cast(l_quantity as int) as quantity",
        "cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint) as cents",
        "l_discount",
    )


class _Mapping:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._frames: dict[str, DataFrame] = {}
        self._counts: dict[str, int] = {}

    def dataset(self, as_of: datetime) -> Dataset:
        names = (
            "warehouses product_categories suppliers employees products customers purchase_orders "
            "purchase_order_items sales_orders sales_order_items inventory stock_transfers"
        ).split()
        ds = Dataset(
            self.spark,
            {
                **{name: getattr(self, f"_{name}") for name in names},
                "inventory_movements": lambda: derive_movements(ds).unionByName(self._adjustments()),
            },
            as_of,
            origin=self.path,
        )
        return ds

    def _read(self, table: str) -> DataFrame:
        if table not in self._frames:
            reader = self.spark.read.schema(SOURCE_SCHEMAS[table])
            self._frames[table] = reader.parquet(f"{self.path}/{table}.parquet")
        return self._frames[table]

    def _count(self, table: str) -> str:
        """Footer-only count, read once for each dataset."""
        if table not in self._counts:
            self._counts[table] = self._read(table).count()
        return f"{self._counts[table]}L"

    def _warehouses(self) -> DataFrame:
        region = self._read("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return (
            self._read("nation")
            .join(region, "n_regionkey")
            .selectExpr(
                "cast(n_nationkey + 1 as bigint) as warehouse_id",
                "concat('Warehouse ', n_name) as name",
                "cast(null as string) as address",
                "n_name as city",
                "cast(null as string) as state",
                "r_name as country",
                f"cast({self._count('part')} * (140 + 10 * (n_nationkey % 5)) as bigint) as capacity_units",
                f"{FOUNDED} as created_at",
            )
        )

    def _employees(self) -> DataFrame:
        titles = ", ".join(f"'{t}'" for t in JOB_TITLES)
        return self._read("customer").selectExpr(
            "c_custkey + 1 as employee_id",
            "cast(c_nationkey + 1 as bigint) as warehouse_id",
            "case when c_custkey >= 3 then (c_custkey - 1) div 3 + 1 end as manager_id",
            "concat('First', c_custkey % 20) as first_name",
            "concat('Last', c_custkey % 7) as last_name",
            "concat('e', c_custkey, '@staff.example') as email",
            "cast(null as string) as phone",
            f"""case when c_custkey < 3 then '{HEAD_TITLE}'
                else elt(cast(c_custkey % 7 + 1 as int), {titles}) end as job_title""",
            "date_add(date '1990-01-01', cast(c_custkey % 1800 as int)) as hire_date",
            f"{FOUNDED} as created_at",
        )

    def _product_categories(self) -> DataFrame:
        part = self._read("part")
        roots = part.selectExpr(
            f"{ROOT_CATEGORY} as category_id", "p_type as name", "cast(null as bigint) as parent_category_id"
        )
        children = part.selectExpr(
            f"{CHILD_CATEGORY} as category_id",
            "concat(p_type, ' ', p_brand) as name",
            f"{ROOT_CATEGORY} as parent_category_id",
        )
        return roots.distinct().unionByName(children.distinct())

    def _suppliers(self) -> DataFrame:
        nation = self._read("nation").withColumnRenamed("n_nationkey", "s_nationkey")
        return (
            self._read("supplier")
            .join(nation, "s_nationkey")
            .selectExpr(
                "s_suppkey + 1 as supplier_id",
                "s_name as name",
                "cast(null as string) as contact_name",
                "cast(null as string) as email",
                "cast(null as string) as phone",
                "n_name as country",
                "case when s_suppkey % 10 != 9 then cast((20 + s_suppkey * 7 % 31) * 0.1 as decimal(2,1)) end as rating",
                f"{FOUNDED} as created_at",
            )
        )

    def _products(self) -> DataFrame:
        return self._read("part").selectExpr(
            "p_partkey + 1 as product_id",
            "concat('SKU', p_partkey) as sku",
            "concat(p_name, ' ', p_brand) as name",
            f"{CHILD_CATEGORY} as category_id",
            f"p_partkey % {self._count('supplier')} + 1 as supplier_id",
            "cast(p_retailprice as decimal(10,2)) as unit_price",
            "cast(cast(p_retailprice as decimal(10,2)) - (100 + p_partkey % 400) as decimal(10,2)) as unit_cost",
            "5 + p_size % 46 as reorder_level",
            "cast(50 + p_partkey % 151 as int) as reorder_qty",
            f"{FOUNDED} as created_at",
        )

    def _customers(self) -> DataFrame:
        nation = self._read("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return (
            self._read("customer")
            .join(nation, "c_nationkey")
            .selectExpr(
                "c_custkey + 1 as customer_id",
                "c_name as name",
                "concat('c', c_custkey, '@mail.example') as email",
                "cast(null as string) as phone",
                "cast(null as string) as address",
                "cast(null as string) as city",
                "n_name as country",
                """case when c_mktsegment in ('AUTOMOBILE', 'HOUSEHOLD') then 'retail'
                    when c_mktsegment = 'BUILDING' and c_custkey % 2 = 0 then 'wholesale'
                    when c_mktsegment = 'MACHINERY' then 'enterprise' else 'online' end as segment""",
                f"{FOUNDED} as created_at",
            )
        )

    def _sales_orders(self) -> DataFrame:
        return self._read("orders").selectExpr(
            "o_orderkey + 1 as so_id",
            "o_custkey + if(o_custkey % 50 = 0, 2, 1) as customer_id",
            f"o_custkey % {WAREHOUSES} + 1 as warehouse_id",
            f"(o_custkey + o_orderkey) % {self._count('customer')} + 1 as employee_id",
            "cast(o_orderdate as date) as order_date",
            """case when o_orderkey % 20 > 1
                then date_add(cast(o_orderdate as date), cast(o_orderkey % 5 + 1 as int)) end as ship_date""",
            """case when o_orderkey % 20 = 0 then 'cancelled' when o_orderkey % 20 = 1 then 'pending'
                when o_orderkey % 20 <= 3 then 'shipped' else 'delivered' end as status""",
            "o_orderdate as created_at",
        )

    def _sales_order_items(self) -> DataFrame:
        return self._lines().selectExpr(
            "line_id as so_item_id",
            "order_id as so_id",
            "product_id",
            "quantity",
            "cast(cents * 0.01 as decimal(10,2)) as unit_price",
            "cast(round(l_discount * 100) as decimal(4,2)) as discount_pct",
        )

    def _purchase_orders(self) -> DataFrame:
        return self._read("orders").selectExpr(
            "o_orderkey + 1 as po_id",
            f"o_orderkey % {self._count('supplier')} + 1 as supplier_id",
            f"o_custkey % {WAREHOUSES} + 1 as warehouse_id",
            f"o_orderkey * 3 % {self._count('customer')} + 1 as employee_id",
            "cast(o_orderdate as date) as order_date",
            "date_add(cast(o_orderdate as date), cast(5 + o_custkey % 17 as int)) as expected_delivery_date",
            """case when o_orderkey % 20 > 3 then date_add(cast(o_orderdate as date),
                cast(3 + o_custkey % 17 + (o_custkey + o_orderkey) % 13 as int)) end as actual_delivery_date""",
            """case when o_orderkey % 20 = 0 then 'pending' when o_orderkey % 20 <= 2 then 'shipped'
                when o_orderkey % 20 = 3 then 'cancelled' else 'received' end as status""",
            "o_orderdate as created_at",
        )

    def _purchase_order_items(self) -> DataFrame:
        return self._lines().selectExpr(
            "line_id as po_item_id",
            "order_id as po_id",
            "product_id",
            "quantity * 10 as quantity_ordered",
            """quantity * case when l_orderkey % 20 > 3 then 10 when l_orderkey % 20 in (1, 2) then 5 else 0 end
                as quantity_received""",
            "cast((cents * 6 div 10) * 0.01 as decimal(10,2)) as unit_cost",
        )

    def _placed(self) -> DataFrame:
        """Lines with their part, the number of parts, and their place inside the part."""
        lines = self._read("lineitem")
        largest = lines.groupBy("l_orderkey").agg(F.count("*").alias("n")).agg(
            F.greatest(F.lit(LEAST_PARTS), F.max("n").cast("bigint") / LINES_PER_PART + 1).cast("bigint")
        )
        parts = F.coalesce(largest.scalar(), F.lit(LEAST_PARTS)).cast("bigint")
        marked = lines.withColumn("part", F.pmod(F.expr(LINE_MARK), parts)).withColumn("parts", parts)
        place = F.row_number().over(W.partitionBy("l_orderkey", "part").orderBy(*LINE_ORDER)).cast("bigint")
        return marked.withColumn("place", place)

    def _lines(self) -> DataFrame:
        """Lines with their id and whole-cent price.

        The two counts that lay ids out are scalar subqueries: a plan that drops the id runs neither them nor the window.
        """
        if "lines" not in self._frames:
            placed = self._placed()
            room = placed.groupBy("l_orderkey", "part").agg(F.count("*").alias("n")).agg(F.max("n"))
            self._frames["lines"] = _with_ids(placed, room)
        return self._frames["lines"]

    def store_lines(self) -> None:
        """Number the lines once, into the shared folder: each plan that reads ids sorts all lines anew otherwise."""
        placed = self._placed().select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "part", "parts", "place")
        folder = f"{shared_folder(self.spark)}/stockyard-{uuid.uuid4().hex}"
        placed.write.parquet(folder)
        stored = self.spark.read.schema(placed.schema).parquet(folder)
        self._frames["lines"] = _with_ids(stored, stored.agg(F.max("place")))

    def _inventory(self) -> DataFrame:
        """Each part is stocked at five warehouses, every fifth beginning with ``part % 5``."""
        return (
            self._read("part")
            .selectExpr("p_partkey as p", "explode(transform(array(0, 1, 2, 3, 4), shelf -> p_partkey % 5 + 5 * shelf)) as n")
            .selectExpr("p", "n", "cast((p * 37 + n * 101) % if((p + n) % 4 = 0, 8, 2001) as int) as on_hand")
            .selectExpr(
                f"p * {WAREHOUSES} + n + 1 as inventory_id",
                "p + 1 as product_id",
                "n + 1 as warehouse_id",
                "on_hand as quantity_on_hand",
                "on_hand % 200 as quantity_reserved",
                "timestamp_ntz '2001-08-01 00:00:00' as last_updated",
            )
        )

    def _stock_transfers(self) -> DataFrame:
        return self._read("orders").selectExpr(
            "o_orderkey + 1 as transfer_id",
            f"o_orderkey % {self._count('part')} + 1 as product_id",
            f"o_custkey % {WAREHOUSES} + 1 as from_warehouse_id",
            f"(o_custkey + 1 + o_custkey % 23) % {WAREHOUSES} + 1 as to_warehouse_id",
            f"o_orderkey * 11 % {self._count('customer')} + 1 as employee_id",
            "cast(10 + o_orderkey % 291 as int) as quantity",
            "cast(o_orderdate as date) as transfer_date",
            """case when o_custkey % 10 < 8 then 'completed' when o_custkey % 10 = 8 then 'in_transit'
                else 'cancelled' end as status""",
        )

    def _adjustments(self) -> DataFrame:
        """Error events stand for stock corrections; the model derives none by itself."""
        return (
            self._read("events")
            .filter("event_type = 'error'")
            .selectExpr(
                f"event_id * 10 + {movement_code('adjustment')} as movement_id",
                f"event_id % {self._count('part')} + 1 as product_id",
                f"user_id % {WAREHOUSES} + 1 as warehouse_id",
                "'adjustment' as movement_type",
                "cast(-(event_id % 5 + 1) as int) as quantity",
                "event_id as reference_id",
                "'adjustment' as reference_type",
                "ts - interval 23 years as movement_date",
            )
        )
