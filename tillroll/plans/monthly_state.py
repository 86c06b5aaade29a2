"""The monthly job over stored, mergeable aggregates: a run reads new files only.

A state folder holds, for every set of files added so far, one *generation* of
small tables at the grains from which all published tables derive:

* ``invoices`` (month, invoice), ``days`` (month, day), ``customers``
  (month, customer), ``skus`` (month, SKU) and ``returns`` (month, SKU,
  description): their columns add up, so generations merge by one aggregate.
* ``numbers``: a dense number for every customer, given when first seen, and
  ``bitmaps``: per month and bucket of 32,768 numbers the bitmap of customers
  that bought.  Bitmaps merge by OR; distinct customers are bit counts, repeat
  customers the bit counts of neighbouring months' AND.  No customer row moves.
* ``cohort_cells`` (frequency, first period, period, customers): signed
  counts.  A new line of a customer may move the customer's first period back;
  the generation then holds what the old cells lose and the new ones gain.
  Only customers of the new lines are looked up.
* ``files``: path, length and modification time of the raw files.

``add_files`` lists a raw folder, leaves out what ``files`` holds already,
aggregates the rest into a new generation and commits a manifest that names
it.  A run that stops before the commit leaves the state as it was.  A file
that was added and has changed since is an error: what it gave cannot be told
from the rest any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll import operators as ops
from tillroll import schema as S
from tillroll.functions.columns import FREQS, check_freq, period_label, period_ordinal, period_start, safe_ratio
from tillroll.operators.clean import clean_lines
from tillroll.plans.manifest import Manifests
from tillroll.plans.materialize import drop_path, table_path, write_and_read
from tillroll.plans.pipeline import build_tables

#: Keys and merging aggregate of every table.
KEYS = {
    "invoices": (S.MONTH, S.INVOICE),
    "days": (S.MONTH, S.ORDER_DATE),
    "customers": (S.MONTH, S.CUSTOMER),
    "skus": (S.MONTH, S.STOCK),
    "returns": (S.MONTH, S.STOCK, S.DESCRIPTION),
    "numbers": (S.CUSTOMER, "number"),
    "bitmaps": (S.MONTH, "bucket"),
    "cohort_cells": ("freq", "cohort", "period"),
    "files": ("path", "length", "modificationTime"),
}
_MERGE = {"_g_max_ts": F.max, "bitmap": F.bitmap_or_agg}
#: Generations beyond which ``add_files`` merges them into one.
MOST_GENERATIONS = 24


class MonthlyState:
    """The state in ``folder`` (any Hadoop file system)."""

    def __init__(self, spark: SparkSession, folder: str, money_scale: int = S.MONEY_SCALE):
        self.spark, self.folder, self.money_scale = spark, folder.rstrip("/"), money_scale
        self.manifests = Manifests(spark, self.folder)
        self.reload()

    def reload(self) -> None:
        self.version, content = self.manifests.latest()
        self.generations: list[str] = content.get("generations", [])
        scale = content.get("money_scale", self.money_scale)
        if scale != self.money_scale:
            raise ValueError(f"the state holds money with {scale} decimals, not {self.money_scale}")

    # Reading -----------------------------------------------------------------

    def table(self, name: str) -> DataFrame | None:
        """A merged table, or None while the state is empty.  Rows of one
        generation have distinct keys already and need no aggregate."""
        held = self._held(name)
        if held is None or len(self.generations) == 1:
            return held
        values = [c for c in held.columns if c not in KEYS[name]]
        if not values:
            return held.distinct()
        types = {f.name: f.dataType for f in held.schema.fields}
        return held.groupBy(*KEYS[name]).agg(
            *[_MERGE.get(c, F.sum)(c).cast(types[c]).alias(c) for c in values]
        )

    def _held(self, name: str) -> DataFrame | None:
        """The rows of all generations, not merged; None while there are none."""
        if not self.generations:
            return None
        return self.spark.read.parquet(*[f"{self.folder}/{g}/{name}" for g in self.generations])

    def _need(self, name: str) -> DataFrame:
        found = self.table(name)
        if found is None:
            raise ValueError(f"no files were added to the state in {self.folder}")
        return found

    def month_facts(self) -> DataFrame:
        return ops.month_facts(
            None, cust=self._need("customers"), invoices=self._need("invoices"), days=self._need("days")
        )

    def cohort_table(self, freq: str = "M") -> DataFrame:
        """The cohort table from its kept cells (no customer is read)."""
        check_freq(freq)
        cells = self._need("cohort_cells").where((F.col("freq") == freq) & (F.col("customers") > 0))
        index = (period_ordinal("period", freq) - period_ordinal("cohort", freq)).cast("int")
        return cells.select(
            period_label("cohort", freq).alias("cohort_month"),
            index.alias("cohort_index"),
            F.col("customers").alias("customer_count"),
        )

    def customer_counts(self) -> DataFrame:
        """Distinct customers per month from the bitmaps."""
        counted = self._need("bitmaps").groupBy(S.MONTH)
        return counted.agg(F.sum(F.bitmap_count("bitmap")).alias("customer"))

    def retention(self) -> DataFrame:
        """``operators.retention`` from the bitmaps: a month's customers and
        those of them in the next month with product lines are bit counts, so
        what moves is a row per month and 32,768 customers."""
        months = self._need("invoices").where("_p_rows > 0").select(S.MONTH).distinct()
        order = Window.orderBy(S.MONTH)  # one row per month
        calendar = months.select(S.MONTH, F.lead(S.MONTH).over(order).alias("_next")).where("_next is not null")
        maps = self._need("bitmaps")
        # Each bitmap under its own month and under the month before.
        pairs = (
            maps.join(F.broadcast(calendar.select(F.col(S.MONTH).alias("_of"), F.col("_next").alias(S.MONTH))), S.MONTH)
            .select(F.col("_of").alias(S.MONTH), "bucket", "bitmap")
            .unionByName(maps)
        )
        both = pairs.groupBy(S.MONTH, "bucket").agg(
            F.count(F.lit(1)).alias("_held"), F.bitmap_and_agg("bitmap").alias("_both")
        )
        repeat = both.where("_held = 2").groupBy(S.MONTH).agg(F.sum(F.bitmap_count("_both")).alias("_repeat"))
        base = self.customer_counts()
        out = calendar.join(F.broadcast(base), S.MONTH, "left").join(F.broadcast(repeat), S.MONTH, "left")
        current = F.coalesce(F.col("customer"), F.lit(0)).cast("bigint")
        again = F.coalesce(F.col("_repeat"), F.lit(0)).cast("bigint")
        return out.select(
            S.MONTH,
            current.alias("current_customers"),
            again.alias("repeat_customers"),
            safe_ratio(again, current).alias("next_month_repeat_rate"),
        )

    def tables(self, cohort_freq: str = "M", cache_small: bool = False, **table_args) -> dict[str, DataFrame]:
        """All published tables and report frames, from the state alone."""
        return build_tables(
            None,
            shared=(self._need("customers"), self.month_facts()),
            sku=self._need("skus"),
            returns=self._need("returns"),
            cohorts=self.cohort_table(cohort_freq),
            cache_small=cache_small,
            **table_args,
        )

    # Adding ------------------------------------------------------------------

    def new_files(self, raw_folder: str) -> DataFrame:
        """(path, length, modificationTime) of the files below ``raw_folder``
        that the state does not hold.  Spark lists them; no content is read."""
        found = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(raw_folder)
            .select("path", "length", F.col("modificationTime").cast("timestamp_ntz"))
        )
        known = self.table("files")
        if known is None:
            return found
        changed = found.join(known.withColumnRenamed("length", "_l").withColumnRenamed("modificationTime", "_t"), "path")
        changed = changed.where("length <> _l or modificationTime <> _t").select("path").limit(1).collect()
        if changed:
            raise ValueError(f"file was added before and has changed since: {changed[0].path}")
        return found.join(known.select("path"), "path", "left_anti")

    def add_files(self, raw_folder: str, reader: Callable[[list[str]], DataFrame]) -> int:
        """Add the new files below ``raw_folder``; ``reader`` turns a list of
        paths into raw lines.  Returns how many files were added."""
        new = self.new_files(raw_folder).collect()  # paths only
        if not new:
            return 0
        files = self.spark.createDataFrame(new, "path string, length long, modificationTime timestamp_ntz")
        self._add(reader([r.path for r in new]), files)
        return len(new)

    def _add(self, raw: DataFrame, files: DataFrame) -> None:
        name = f"gen-{uuid.uuid4().hex}"
        lines_path = table_path(self.spark, "new_lines")
        try:
            # The new lines are read once; five aggregates start from them.
            fact = write_and_read(_needed(clean_lines(raw, self.money_scale)), "new_lines", path=lines_path)

            def put(table: str, df: DataFrame) -> DataFrame:
                path = f"{self.folder}/{name}/{table}"
                df.write.mode("overwrite").parquet(path)
                return self.spark.read.parquet(path)

            put("files", files)
            put("invoices", ops.invoice_months(fact))
            put("days", ops.active_days(fact))
            put("skus", ops.sku_month(fact))
            put("returns", ops.return_sku_month(fact))
            added = put("customers", ops.customer_month_sales(fact).select(S.MONTH, S.CUSTOMER, "cust_gmv"))
            numbers = put("numbers", self._new_numbers(added))
            known = self.table("numbers")
            put("bitmaps", _bitmaps(added, numbers if known is None else numbers.unionByName(known)))
            put("cohort_cells", self._cell_changes(added))
            generations = [*self.generations, name]
            self.manifests.commit(self.version, {"generations": generations, "money_scale": self.money_scale})
        except BaseException:
            self.manifests.drop(name)
            raise
        finally:
            drop_path(self.spark, lines_path)
        self.reload()
        if len(self.generations) > MOST_GENERATIONS:
            self.compact()

    def _new_numbers(self, added: DataFrame) -> DataFrame:
        """Numbers for customers seen for the first time: consecutive from the
        largest one given so far.  A customer's place is the number of rows in
        earlier partitions and its place in its own."""
        known = self.table("numbers")
        new, start = added.select(S.CUSTOMER).distinct(), 0
        if known is not None:
            new = new.join(known.select(S.CUSTOMER), S.CUSTOMER, "left_anti")
            start = known.agg(F.max("number")).first()[0] or 0
        path = table_path(self.spark, "new_customers")
        try:
            placed = write_and_read(new.withColumn("_row", F.monotonically_increasing_id()), "new_customers", path=path)
            part = F.shiftright("_row", 33)
            # One row per partition.
            sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect()
            before, offsets = start, []
            for r in sorted(sizes):
                offsets.append((r["_part"], before))
                before += r["_n"]
            table = self.spark.createDataFrame(offsets, "_part long, _before long")
            numbered = placed.withColumn("_part", part).join(F.broadcast(table), "_part")
            number = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1
            out = table_path(self.spark, "numbers")
            return write_and_read(numbered.select(S.CUSTOMER, number.alias("number")), "numbers", path=out)
        finally:
            drop_path(self.spark, path)

    def _cell_changes(self, added: DataFrame) -> DataFrame:
        """Signed changes of the cohort cells: the touched customers' cells
        after the new lines, less those before."""
        pairs = added.select(S.CUSTOMER, S.MONTH, F.lit(False).alias("_old"))
        known = self._held("customers")
        if known is not None:
            touched = added.select(S.CUSTOMER).distinct()
            old = known.select(S.CUSTOMER, S.MONTH, F.lit(True).alias("_old"))
            pairs = pairs.unionByName(old.join(touched, S.CUSTOMER, "left_semi"))
        return _cell_sums(pairs)

    # Housekeeping --------------------------------------------------------------

    def compact(self) -> None:
        """Merge all generations into one (a new version)."""
        if len(self.generations) < 2:
            return
        name = f"gen-{uuid.uuid4().hex}"
        try:
            for table in KEYS:
                df = self.table(table)
                df = df.where("customers <> 0") if table == "cohort_cells" else df
                df.write.mode("overwrite").parquet(f"{self.folder}/{name}/{table}")
            self.manifests.commit(self.version, {"generations": [name], "money_scale": self.money_scale})
        except BaseException:
            self.manifests.drop(name)
            raise
        self.reload()

    def vacuum(self) -> list[str]:
        """Delete generations that the newest manifest does not name (call it
        when no reader uses an older version and no writer runs)."""
        gone = [n for n in self.manifests.names() if n.startswith("gen-") and n not in self.generations]
        for name in gone:
            self.manifests.drop(name)
        return gone


def _needed(fact: DataFrame) -> DataFrame:
    """What the aggregates read of the fact lines: no country, flags or line
    amount, and the description of RETURN lines only."""
    description = F.when(F.col(S.TYPE) == S.TYPE_RETURN, F.col(S.DESCRIPTION))
    return fact.select(
        S.INVOICE, S.STOCK, description.alias(S.DESCRIPTION), S.QUANTITY, S.INVOICE_DATE, S.UNIT_PRICE, S.CUSTOMER,
        S.TYPE, "net_gmv", "return_value", S.ORDER_DATE, S.MONTH, "abs_quantity",
    )


def _bitmaps(customer_months: DataFrame, numbers: DataFrame) -> DataFrame:
    """(month, bucket, bitmap) of the customers' numbers.  The numbers move, not
    a bitmap of 4 KB for every bucket and month that a task has: that would
    grow with the tasks times the customers."""
    numbered = customer_months.select(S.MONTH, S.CUSTOMER).join(numbers, S.CUSTOMER)
    placed = numbered.select(S.MONTH, F.bitmap_bucket_number("number").alias("bucket"), "number")
    # At most 32,768 rows a month and bucket.
    return placed.repartition(S.MONTH, "bucket").groupBy(S.MONTH, "bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def _cell_sums(pairs: DataFrame) -> DataFrame:
    """(freq, cohort, period, customers) from (customer, month, ``_old``) rows:
    the cells of all rows less those of the old ones, all frequencies in one
    pass.  A customer's rows meet once; the windows hold one row per month,
    whatever the line count.  A customer counts in a period at the customer's
    first month there."""
    months = pairs.repartition(S.CUSTOMER).groupBy(S.CUSTOMER, S.MONTH).agg(F.max("_old").alias("_old"))
    whole = Window.partitionBy(S.CUSTOMER).orderBy(S.MONTH)
    past = whole.rowsBetween(Window.unboundedPreceding, -1)
    own = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    old = F.when(F.col("_old"), F.col(S.MONTH))
    dated = months.select(
        S.MONTH,
        "_old",
        F.min(S.MONTH).over(own).alias("_first"),
        F.max(S.MONTH).over(past).alias("_before"),
        F.min(old).over(own).alias("_old_first"),
        F.max(old).over(past).alias("_old_before"),
    )
    cells = []
    for freq in FREQS:
        period = period_start(S.MONTH, freq)
        for held, first, before, sign in ((F.lit(True), "_first", "_before", 1), (F.col("_old"), "_old_first", "_old_before", -1)):
            begins = F.col(before).isNull() | (period_start(before, freq) < period)
            cell = F.struct(
                F.lit(freq).alias("freq"), period_start(first, freq).alias("cohort"), period.alias("period"),
                F.lit(sign).cast("bigint").alias("customers"),
            )
            cells.append(F.when(held & begins, cell))
    cell = F.explode(F.array_compact(F.array(*cells))).alias("_cell")
    merged = dated.select(cell).select("_cell.*").groupBy("freq", "cohort", "period")
    return merged.agg(F.sum("customers").alias("customers")).where("customers <> 0")
