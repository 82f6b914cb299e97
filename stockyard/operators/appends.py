"""Integrity of an appended batch without reading the stored tables again.

Beside the tables lies a book of their keys: exact bitmaps for number keys, and for text and composite keys a Bloom filter, both in
pieces of 32,768 bits that merge by bitwise or. A number key is looked up in its bitmap, which settles uniqueness and references
alone. A text key that the filter may hold goes to an exact join with the stored column; no other reads the stored table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.dataset import Dataset
from stockyard.operators.quality import row_rules, tagged
from stockyard.schema import TABLES, Table
from stockyard.session import materialize
from stockyard.sources.buckets import Batches

PIECE_LOG = 15
PIECE = 1 << PIECE_LOG  # bits of one piece, as bitmap_construct_agg has them
HASHES = 3
_PIECES = T.StructType([T.StructField("key_name", T.StringType()), T.StructField("piece", T.LongType()), T.StructField("bits", T.BinaryType())])


def key_sets(spec: Table) -> list[tuple[str, ...]]:
    return [spec.primary_key, *spec.unique]


def _is_number(spec: Table, columns: tuple[str, ...]) -> bool:
    return len(columns) == 1 and isinstance(spec.column(columns[0]).type, (T.LongType, T.IntegerType))


def _text(columns: tuple[str, ...]) -> Column:
    """A key as text; NULL if a part of it is."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return F.when(known, F.concat_ws(",", *[F.col(c).cast("string") for c in columns]))


def _named(key_name: str, places: Column) -> Column:
    return F.transform(places, lambda at: F.struct(F.lit(key_name).alias("key_name"), at["piece"].alias("piece"), at["bit"].alias("bit")))


class KeyBook:
    """``bits``: the size of a table's filter for each text key; ten times the keys expected leave about two of a hundred new keys
    to the exact join. Pieces are written as they are touched, so a roomy size costs nothing before it is used.
    """

    def __init__(self, spark: SparkSession, path: str, bits: int = 1 << 30):
        self.spark, self.path, self.bits = spark, path.rstrip("/"), bits

    def _file(self, table: str) -> Batches:
        return Batches(self.spark, f"{self.path}/{table}", _PIECES)

    def record(self, table: str, rows: DataFrame, batch: int = 0) -> None:
        """Note the keys of a batch; the same number again replaces what it noted."""
        self._file(table).put(batch, self._pieces(TABLES[table], rows))

    def compact(self, table: str, into: KeyBook) -> None:
        """One piece of each place, in another book."""
        into._file(table).put(0, _merged(self._file(table).rows()))

    def pieces(self, table: str) -> DataFrame:
        return _merged(self._file(table).rows())

    def _pieces(self, spec: Table, rows: DataFrame) -> DataFrame:
        places = []
        for columns in key_sets(spec):
            if _is_number(spec, columns):
                key = F.col(columns[0]).cast("bigint")
                at = F.array(F.struct(F.bitmap_bucket_number(key).alias("piece"), F.bitmap_bit_position(key).alias("bit")))
            else:
                key = _text(columns)
                at = self.places(key)
            places.append(F.when(key.isNotNull(), _named("_".join(columns), at)))
        noted = rows.select(F.inline(F.flatten(F.filter(F.array(*places), lambda one: one.isNotNull()))))
        return noted.groupBy("key_name", "piece").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def places(self, text: Column) -> Column:
        """The places of a text key in its filter."""
        spots = [F.pmod(F.xxhash64(text, F.lit(seed)), F.lit(self.bits).cast("bigint")) for seed in range(HASHES)]
        return F.array(*[F.struct(F.shiftright(s, PIECE_LOG).alias("piece"), s.bitwiseAND(F.lit(PIECE - 1)).alias("bit")) for s in spots])


def _merged(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("key_name", "piece").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: str, bit: str) -> Column:
    byte = f"cast(conv(hex(substring({bits}, cast({bit} div 8 as int) + 1, 1)), 16, 10) as bigint)"
    return F.expr(f"coalesce(getbit({byte}, cast({bit} % 8 as int)), 0) = 1")


def check_append(ds: Dataset, table: str, batch: DataFrame, book: KeyBook) -> DataFrame:
    """The report ``quality.validate`` would give of ``table`` with the batch in it, the stored rows being sound.

    One row per rule: table, rule, kind, violations, sample_key. The book knows the table and those it refers to.
    """
    spec = TABLES[table]
    rules: list[tuple[str, str]] = []
    numbers: list[tuple[int, str, str, Column]] = []  # rule, table whose keys are asked, key, value
    texts: list[tuple[int, tuple[str, ...]]] = []
    for columns in key_sets(spec):
        name = "_".join(columns)
        if _is_number(spec, columns):
            numbers.append((len(rules), table, name, F.col(columns[0])))
        else:
            texts.append((len(rules), columns))
        rules.append((f"{name}_unique", "primary_key" if columns == spec.primary_key else "unique"))
    for fk in spec.foreign_keys:
        numbers.append((len(rules), fk.table, fk.key, F.col(fk.column)))
        rules.append((f"{fk.column}_exists", "foreign_key"))
    names = ds.spark.createDataFrame([(i, table, *rule) for i, rule in enumerate(rules)], "rule_no int, table string, rule string, kind string")
    found = _numbers(batch, spec, numbers, names, book).unionByName(_texts(ds, batch, spec, texts, book))
    summed = found.groupBy("rule_no").agg(F.sum("surplus").alias("violations"), F.min("key").alias("sample_key"))
    keyed = names.join(summed, "rule_no", "left").select(
        "table", "rule", "kind", F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"), "sample_key"
    )
    return row_rules(spec, batch).unionByName(keyed)


def _numbers(batch: DataFrame, spec: Table, numbers: list, names: DataFrame, book: KeyBook) -> DataFrame:
    """Number keys and references against the bitmaps; at most a piece's bits of different keys meet one piece."""
    asked = batch.select(F.inline(F.array(*[tagged(rule, value.cast("bigint")) for rule, _, _, value in numbers])))
    asked = asked.filter("key is not null").groupBy("rule_no", "key").agg(F.count("*").alias("n"))
    asked = asked.join(F.broadcast(names.select("rule_no", "kind")), "rule_no")  # a row for each rule
    pieces = []
    for rule, table, name, _ in numbers:
        stored = book._file(table).rows()
        if table == spec.name and rule >= len(key_sets(spec)):  # rows of the batch may refer to each other
            stored = stored.unionByName(book._pieces(spec, batch))
        pieces.append(_merged(stored.filter(F.col("key_name") == name)).select(F.lit(rule).alias("rule_no"), "piece", "bits"))
    placed = asked.withColumns({"piece": F.bitmap_bucket_number("key"), "bit": F.bitmap_bit_position("key")})
    held = placed.join(reduce(DataFrame.unionByName, pieces), ["rule_no", "piece"], "left").withColumn("held", _is_set("bits", "bit"))
    surplus = F.when(F.col("kind") == "foreign_key", F.when(F.col("held"), 0).otherwise(F.col("n")))
    surplus = surplus.otherwise(F.col("n") - F.when(F.col("held"), 0).otherwise(1))
    return held.select("rule_no", surplus.alias("surplus"), F.col("key").cast("string").alias("key")).filter("surplus > 0")


def _texts(ds: Dataset, batch: DataFrame, spec: Table, texts: list, book: KeyBook) -> DataFrame:
    """Text keys: those the filter may hold are joined with the stored column, the rest with nothing."""
    empty = ds.spark.createDataFrame([], "rule_no int, surplus bigint, key string")
    if not texts:
        return empty
    keys = batch.select(F.inline(F.array(*[tagged(rule, _text(columns)) for rule, columns in texts])))
    keys = materialize(keys.filter("key is not null").groupBy("rule_no", "key").agg(F.count("*").alias("n")))
    candidates = materialize(may_hold(keys, spec, texts, book))
    held = candidates.limit(0)
    if not candidates.isEmpty():  # the stored table is not opened otherwise
        stored = getattr(ds, spec.name).select(F.inline(F.array(*[tagged(rule, _text(columns)) for rule, columns in texts])))
        held = stored.join(candidates, ["rule_no", "key"], "left_semi").distinct()
    counted = keys.join(held.withColumn("held", F.lit(1)), ["rule_no", "key"], "left")
    surplus = F.col("n") - 1 + F.coalesce("held", F.lit(0))
    return counted.select("rule_no", surplus.alias("surplus"), "key").filter("surplus > 0")


def may_hold(keys: DataFrame, spec: Table, texts: list, book: KeyBook) -> DataFrame:
    """Those of the text keys (rule_no, key) whose every place in the filter is set."""
    pieces = [
        book.pieces(spec.name).filter(F.col("key_name") == "_".join(columns)).select(F.lit(rule).alias("rule_no"), "piece", "bits")
        for rule, columns in texts
    ]
    places = keys.select("rule_no", "key", F.inline(book.places(F.col("key"))))
    spots = places.select("rule_no", "piece", "bit").distinct()  # many keys, few bits: at most a piece's bits meet one piece
    lit = spots.join(reduce(DataFrame.unionByName, pieces), ["rule_no", "piece"]).filter(_is_set("bits", "bit")).drop("bits")
    full = places.join(lit, ["rule_no", "piece", "bit"]).groupBy("rule_no", "key").agg(F.count("*").alias("lit"))
    return full.filter(F.col("lit") == HASHES).drop("lit")
