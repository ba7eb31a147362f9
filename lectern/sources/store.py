"""Content, problems and sessions as plain Parquet tables, partitioned by the day of expiry.

The operators are those of ``lectern.operators.content``; here they meet tables on disk. Removals touch only what holds
a row to remove: a partition that expires as a whole is dropped, others are rewritten from their survivors. Of each file
a summary says which n-grams its topics have, so a purge reads no file that cannot match, and rewrites only those that do. Ids go on above every id ever issued, also after removals: a writer claims a range before it writes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import fixed_values as V
from lectern.functions.text import fold, topic_matches
from lectern.operators import content as C
from lectern.operators.lookup import all_grams, pattern_grams
from lectern.operators.numbering import assign_ids
from lectern.schemas import STORE_TABLES
from lectern.session import create_once, folder_names, path_exists, remove_file, remove_folder, small_text, stage

DAY = "expires_on"


#: Bits of a file's summary: those of one bitmap.
GRAM_BITS = 32_768


def _gram_bit(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(GRAM_BITS)).cast("long")


def _below(table: str, path: str) -> str:
    return path.rpartition(f"/{table}/")[2]


class StudyStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _with_day(self, table: str) -> DataFrame:
        schema, _ = STORE_TABLES[table]
        if not path_exists(self.spark, self._path(table)):
            return self.spark.createDataFrame([], schema).withColumn(DAY, F.lit(None).cast("string"))
        return self.spark.read.schema(f"{schema.toDDL()}, {DAY} string").parquet(self._path(table))

    def read(self, table: str) -> DataFrame:
        return self._with_day(table).drop(DAY)

    def claim_ids(self, table: str, count: int) -> int:
        """Reserve ``count`` ids and return the first. Claims are numbered files below ``ids``; one is made by creating
        the next number, which only one writer can, and says which id is the last one issued."""
        folder = f"{self.root}/ids/{table}"
        while True:
            made = sorted(name for name in folder_names(self.spark, folder) if name.startswith("claim-"))
            last = self._last_issued(table, f"{folder}/{made[-1]}" if made else None)
            number = int(made[-1].removeprefix("claim-")) + 1 if made else 0
            if create_once(self.spark, f"{folder}/claim-{number:012d}", str(last + count)):
                return last + 1

    def _last_issued(self, table: str, claim: str | None) -> int:
        if claim is None:
            # A table from before there were claims: nothing above its largest id is known to be taken.
            _, id_col = STORE_TABLES[table]
            return self.read(table).agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
        said = small_text(self.spark, claim)
        if not said:
            raise RuntimeError(f"{claim} is being made by another writer; remove it if that writer is gone")
        return int(said)

    def _append(self, table: str, rows: DataFrame, start_id: int | None, order_cols: Sequence[str] | None) -> int:
        """Number and write ``rows``, which may have columns besides the table's to be ordered by."""
        schema, id_col = STORE_TABLES[table]
        day = F.coalesce(F.date_format("expires_at", "yyyy-MM-dd"), F.lit(V.NEVER)) if "expires_at" in schema.fieldNames() else F.lit(V.NEVER)
        numbered = assign_ids(rows, id_col, 0, order_cols)
        count = numbered.count()
        if count:
            start = self.claim_ids(table, count) if start_id is None else start_id
            numbered.withColumn(id_col, F.col(id_col) + F.lit(start).cast("long")).select(*schema.fieldNames(), day.alias(DAY)).write.mode(
                "append").partitionBy(DAY).parquet(self._path(table))
            if table != "sessions":
                self.summarise(table)
        return count

    # --- commands -----------------------------------------------------------------------------

    def store_content(self, incoming: DataFrame, as_of: C.Instant, start_id: int | None = None, ttl_days: int = V.TTL_DAYS,
                      order_cols: Sequence[str] | None = None) -> int:
        """Returns the number of rows stored; rows with an empty body are not. Ids follow ``order_cols`` of
        ``incoming``, which need not be columns of the table; they start at ``start_id`` only if that is given."""
        rows = C.new_content(self.read("content"), incoming, as_of, ttl_days, order_cols or ())
        return self._append("content", rows, start_id, order_cols)

    def store_problems(self, incoming: DataFrame, as_of: C.Instant, start_id: int | None = None, ttl_days: int = V.TTL_DAYS,
                       order_cols: Sequence[str] | None = None) -> int:
        rows = C.new_problems(self.read("problems"), incoming, as_of, ttl_days, order_cols or ())
        return self._append("problems", rows, start_id, order_cols)

    def log_sessions(self, sessions: DataFrame, start_id: int | None = None, order_cols: Sequence[str] | None = None) -> int:
        schema, _ = STORE_TABLES["sessions"]
        filled = sessions.select(*[
            (F.col(f.name) if f.name in sessions.columns else F.lit(0 if f.name == "checkpoint" else None))
            .cast(f.dataType).alias(f.name) for f in schema
        ])
        return self._append("sessions", filled, start_id, order_cols)

    def get(self, text: str, as_of: C.Instant, k: int = V.LATEST_ENTRIES) -> DataFrame:
        return C.latest(self.read("content"), text, as_of, k)

    def get_problems(self, text: str, as_of: C.Instant, difficulty: str | None = None,
                     n: int = V.PROBLEMS_PER_LOOKUP, seed: int = 0) -> DataFrame:
        return C.sample_problems(self.read("problems"), text, as_of, difficulty, n, seed)

    def list_topics(self, as_of: C.Instant) -> DataFrame:
        return C.list_topics(self.read("content"), as_of)

    def list_problem_topics(self, as_of: C.Instant) -> DataFrame:
        return C.list_problem_topics(self.read("problems"), as_of)

    def stats(self, as_of: C.Instant) -> DataFrame:
        return C.store_stats(self.read("content"), self.read("problems"), as_of)

    # --- removals -----------------------------------------------------------------------------

    def _remove(self, table: str, gone: Column) -> int:
        """Remove the rows for which ``gone`` holds, partition by partition; returns how many there were."""
        rows = self._with_day(table).withColumn("_gone", F.coalesce(gone, F.lit(False)))
        # One row per day with something to remove.
        days = rows.groupBy(DAY).agg(F.count_if("_gone").alias("gone"), F.count("*").alias("rows")).filter("gone > 0").collect()
        partly = [d[DAY] for d in days if d["gone"] < d["rows"]]
        if partly:
            kept = stage(rows.filter(F.col(DAY).isin(partly) & ~F.col("_gone")).drop("_gone"), "survivors")
            kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(self._path(table))
        for d in days:
            if d["gone"] == d["rows"]:
                remove_folder(self.spark, f"{self._path(table)}/{DAY}={d[DAY]}")
        return sum(d["gone"] for d in days)

    def _files(self, table: str) -> dict[str, str]:
        """Data files by their name below the table."""
        if not path_exists(self.spark, self._path(table)):
            return {}
        return {_below(table, path): path for path in self._with_day(table).inputFiles()}

    def _summaries(self, table: str) -> DataFrame:
        path = f"{self.root}/topics/{table}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], "name string, grams binary")
        return self.spark.read.schema("name string, grams binary").parquet(path)

    def summarise(self, table: str) -> None:
        """Summarise the files that have no summary yet; their topics are all that is read."""
        known = {r["name"] for r in self._summaries(table).select("name").collect()}
        fresh = [path for name, path in self._files(table).items() if name not in known]
        if not fresh:
            return
        name = F.element_at(F.split("_metadata.file_path", f"/{table}/"), -1)
        topics = self.spark.read.schema("topic string").parquet(*fresh).select(name.alias("name"), fold(F.col("topic")).alias("topic")).distinct()
        grams = topics.select("name", F.explode(F.expr(all_grams("topic"))).alias("gram")).select("name", _gram_bit(F.col("gram")).alias("bit")).distinct()
        grams.groupBy("name").agg(F.bitmap_construct_agg("bit").alias("grams")).write.mode("append").parquet(f"{self.root}/topics/{table}")

    def may_hold(self, table: str, text: str) -> list[str]:
        """Paths of the files that may have a topic containing ``text``: all bits of its grams are set, or nothing is
        known about them."""
        files = self._files(table)
        pattern = self.spark.createDataFrame([(text,)], "p string").select(fold(F.col("p")).alias("p"))
        wanted = pattern.select(F.explode(F.expr(pattern_grams("p"))).alias("gram")).select(_gram_bit(F.col("gram")).alias("bit"))
        rows = self._summaries(table)
        without = F.lit(False)
        for r in wanted.distinct().collect():
            byte = F.conv(F.hex(F.substring("grams", r["bit"] // 8 + 1, 1)), 16, 10).cast("int")
            without = without | (byte.bitwiseAND(F.lit(1 << r["bit"] % 8)) == 0)
        ruled_out = {r["name"] for r in rows.filter(without).select("name").collect()}
        return [path for name, path in files.items() if name not in ruled_out]

    def _purge(self, table: str, text: str) -> int:
        paths = self.may_hold(table, text)
        if not paths:
            return 0
        schema, _ = STORE_TABLES[table]
        rows = self.spark.read.schema(f"{schema.toDDL()}, {DAY} string").option("basePath", self._path(table)).parquet(*paths)
        rows = rows.withColumns({"_file": F.col("_metadata.file_path"), "_gone": F.coalesce(topic_matches(F.col("topic"), text), F.lit(False))})
        # A row per file with something to remove.
        hit = rows.groupBy("_file").agg(F.count_if("_gone").alias("gone"), F.count("*").alias("rows")).filter("gone > 0").collect()
        partly = [r["_file"] for r in hit if r["gone"] < r["rows"]]
        if partly:
            kept = stage(rows.filter(F.col("_file").isin(partly) & ~F.col("_gone")).drop("_file", "_gone"), "survivors")
            kept.write.mode("append").partitionBy(DAY).parquet(self._path(table))
        for r in hit:
            remove_file(self.spark, r["_file"])
        self.summarise(table)
        return sum(r["gone"] for r in hit)

    def purge(self, text: str) -> dict[str, int]:
        """Remove the entries and problems whose topic contains ``text``. Survivors of a file are written before it goes."""
        return {t: self._purge(t, text) for t in ("content", "problems")}

    def clear_expired(self, as_of: C.Instant) -> dict[str, int]:
        """Whole days before ``as_of`` are counted from the files' footers and dropped."""
        removed = {}
        for table in ("content", "problems"):
            rows = self._with_day(table)
            removed[table] = self._remove(table, (F.col(DAY) < str(as_of)[:10]) | ((F.col(DAY) == str(as_of)[:10]) & ~C.is_live(rows, as_of)))
        return removed

    def clear_all(self) -> None:
        """Empty all three tables. What ids were issued stays known."""
        for table in STORE_TABLES:
            remove_folder(self.spark, self._path(table))
            remove_folder(self.spark, f"{self.root}/topics/{table}")
