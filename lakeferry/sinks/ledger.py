"""Tables made of numbered loads, and a ledger that says which loads, days and files readers see.

A table is a folder of Parquet files, ``data/_load=<n>/_day=<day>/``, which are never changed once they are written. Its
ledger is one small JSON document; a change writes files of the next load, then a new ledger, and then replaces the
catalog view, whose filter on folders and file names is the ledger's. Readers see the state before or after a change;
what a failed change left behind is not in the ledger and is overwritten by the next one. A copy of a table is a second
view of the same ledger. There is one writer for a table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeferry.functions.normalize import quoted
from lakeferry.operators.merge import unique_rows, without_keys
from lakeferry.sinks.tables import DAY, PATH_PROPERTY, balanced, clustered, observed

LOAD = "_load"
LEDGER_PROPERTY = "ledger"
NO_DAY = "null"
_DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Ledger:
    """What readers of a table see.

    ``runs`` has the run of each load by its number from 1 on; ``hidden`` are loads that are not seen at all, ``days``
    gives for a day the first load whose rows of that day are seen, and ``files`` are single files that are not seen.
    ``source`` is the ledger of the table that this one was refined from. Copies are ``frozen``: they share the folder of
    the table and take no loads.
    """

    root: str
    runs: tuple[str, ...] = ()
    hidden: tuple[int, ...] = ()
    days: dict[str, int] = field(default_factory=dict)
    files: tuple[str, ...] = ()
    grown: bool = False
    source: dict | None = None
    frozen: bool = False

    @property
    def data(self) -> str:
        return f"{self.root.rstrip('/')}/data"

    @property
    def next_load(self) -> int:
        return len(self.runs) + 1

    def filter(self) -> str:
        """Condition on folders and files."""
        parts = [f"{LOAD} <= {len(self.runs)}"]
        if self.hidden:
            parts.append(f"{LOAD} not in ({', '.join(map(str, self.hidden))})")
        by_load: dict[int, list[str]] = {}
        for day, load in self.days.items():
            by_load.setdefault(load, []).append(day)
        for load, days in sorted(by_load.items()):
            dated = ", ".join(f"date'{d}'" for d in sorted(days) if d != NO_DAY)
            for own in ([f"{DAY} in ({dated})"] if dated else []) + ([f"{DAY} is null"] if NO_DAY in days else []):
                parts.append(f"not ({LOAD} < {load} and coalesce({own}, false))")
        if self.files:
            parts.append(f"_metadata.file_path not in ({', '.join(_text(f) for f in self.files)})")
        return " and ".join(parts)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows that readers see, with their load and day."""
        return self.every_row(spark).where(self.filter())

    def every_row(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("mergeSchema", self.grown).parquet(self.data)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ledger_of(spark: SparkSession, name: str) -> Ledger | None:
    """The ledger that readers of ``name`` see; None when there is no such table.

    A table that has no ledger is refused.
    """
    if not spark.catalog.tableExists(name):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {name}").collect()}.get(LEDGER_PROPERTY)
    if found is None:
        raise ValueError(f"{name} is no table with a ledger")
    return _ledger(json.loads(spark.read.text(found, wholetext=True).first()[0]))


def _ledger(body: dict) -> Ledger:
    return Ledger(**{k: tuple(v) if isinstance(v, list) else v for k, v in body.items()})


def source_of(ledger: Ledger) -> Ledger | None:
    """The ledger that a refined table was made from."""
    return None if ledger.source is None else _ledger(ledger.source)


def commit(spark: SparkSession, name: str, ledger: Ledger) -> None:
    """Let readers of ``name`` see what the ledger says: one small file, then one step in the catalog."""
    path = f"{ledger.root.rstrip('/')}/ledgers/{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps(asdict(ledger)),)], "value string").coalesce(1).write.text(path)
    options = " with ('mergeSchema' = 'true')" if ledger.grown else ""
    columns = ", ".join(quoted(c) for c in ledger.every_row(spark).columns if c not in (DAY, LOAD))
    properties = f"'{LEDGER_PROPERTY}' = {_text(path)}, '{PATH_PROPERTY}' = {_text(ledger.data)}"
    spark.sql(
        f"create or replace view {name} tblproperties ({properties}) as "
        f"select {columns} from parquet.`{ledger.data}`{options} where {ledger.filter()}"
    )


def copy_table(spark: SparkSession, name: str, copy: str) -> None:
    """Let readers of ``copy`` see what ``name`` has now; no row is read or written, and later changes do not show."""
    commit(spark, copy, replace(_known(spark, name), frozen=True))


def _known(spark: SparkSession, name: str) -> Ledger:
    ledger = ledger_of(spark, name)
    if ledger is None:
        raise ValueError(f"there is no table {name}")
    return ledger


def write_load(spark: SparkSession, df: DataFrame, ledger: Ledger, run: str, cluster_by: Sequence[str] = ()) -> Ledger:
    """Write rows as the next load, which is not seen before its ledger is committed; ``df`` has the column of the day.

    A load without rows leaves a file that has the columns.
    """
    if ledger.frozen:
        raise ValueError(f"a copy of the table at {ledger.root} takes no loads")
    path = f"{ledger.data}/{LOAD}={ledger.next_load}"
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    laid = clustered(rows, [DAY], cluster_by) if cluster_by else balanced(rows, [DAY])
    # static, whatever the session says: what a failed load left in the folder goes
    laid.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DAY).parquet(path)
    if not observed(seen, "rows"):
        df.drop(DAY).limit(0).write.mode("overwrite").parquet(f"{path}/{DAY}={_DEFAULT_PARTITION}")
    return replace(ledger, runs=(*ledger.runs, run))


def load_rows(spark: SparkSession, df: DataFrame, name: str, root: str, run: str, whole: bool = False) -> Ledger:
    """Add the rows of a run; the same run again replaces what it loaded before.

    ``whole``: the rows replace the table. Columns that are new are null in older rows.
    """
    ledger = ledger_of(spark, name) or Ledger(root)
    again = [n for n, r in enumerate(ledger.runs, 1) if r == run and n not in ledger.hidden]
    gone = range(1, ledger.next_load) if whole else again
    known = set(ledger.every_row(spark).columns) if ledger.runs else set(df.columns)
    if not whole:
        _require_types(spark, df, ledger)
    written = write_load(spark, df, ledger, run)
    grown = ledger.grown or not set(df.columns) <= known
    written = replace(written, hidden=tuple(sorted({*ledger.hidden, *gone})), grown=grown)
    commit(spark, name, written)
    return written


def _require_types(spark: SparkSession, df: DataFrame, ledger: Ledger) -> None:
    """Files of one table have one type for a column: a load with another one would make the table unreadable."""
    old = dict(ledger.every_row(spark).dtypes) if ledger.runs else {}
    other = [f"{c} was {old[c]} and is {t}" for c, t in df.dtypes if c in old and c != DAY and old[c] != t]
    if other:
        raise ValueError(f"{'; '.join(other)}: widen the table first")


def widen(spark: SparkSession, name: str, types: dict[str, str]) -> Ledger:
    """Give columns of a table other Spark types: every load that is seen is written again, under the run it has.

    A value that the new type does not hold fails the job, and readers keep what they saw.
    """
    ledger = _known(spark, name)
    # files of the old types stay where they are, so the table goes on in a folder of its own
    moved = Ledger(f"{ledger.root.rstrip('/')}/widened-{uuid.uuid4().hex}", source=ledger.source)
    for n in range(1, ledger.next_load):
        if n not in ledger.hidden:
            rows = ledger.rows(spark).where(F.col(LOAD) == n).drop(LOAD)
            moved = write_load(spark, rows.withColumns({c: F.col(quoted(c)).cast(t) for c, t in types.items()}), moved, ledger.runs[n - 1])
    commit(spark, name, moved)
    return moved


def replace_days(
    spark: SparkSession, df: DataFrame, name: str, days: Iterable[str], run: str, cluster_by: Sequence[str] = (), **changes
) -> Ledger:
    """Replace whole days of a table; the files of other days stay. Days are ISO dates or ``NO_DAY``.

    Rows are of these days. A day without rows becomes empty.
    """
    ledger = _known(spark, name)
    number = ledger.next_load
    grown = ledger.grown or not set(df.columns) <= set(ledger.every_row(spark).columns)
    written = write_load(spark, df, ledger, run, cluster_by)
    written = replace(written, days={**ledger.days, **{d: number for d in days}}, grown=grown, **changes)
    commit(spark, name, written)
    return written


def merge_rows(spark: SparkSession, source: DataFrame, name: str, keys: Sequence[str], run: str, day: Callable[[DataFrame], DataFrame]) -> int:
    """Upsert into a table, rewriting only the files that hold a key of ``source``; returns how many these are.

    Files outside the range of the source's keys are left out by their statistics; of the others only the keys are read.
    Rows of the hit files whose key is not in the source are written again, beside all source rows. Keys must be unique
    in the source; null keys match nothing. ``day`` adds the column of the day to the source.
    """
    ledger = _known(spark, name)
    target = ledger.rows(spark)
    low, high = source.agg(F.min(keys[0]), F.max(keys[0])).first()
    near = target.where(F.col(keys[0]).between(F.lit(low), F.lit(high))).select(*keys, F.col("_metadata.file_path").alias("__file"))
    wanted = source.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = [near[k] == wanted[f"__{k}"] for k in keys]
    hit = [r["__file"] for r in near.join(wanted, same, "left_semi").select("__file").distinct().collect()]
    rows = day(unique_rows(source, keys))
    if hit:
        kept = target.where(F.col("_metadata.file_path").isin(hit)).drop(LOAD)
        rows = without_keys(kept, source, keys).unionByName(rows, allowMissingColumns=True)
    grown = ledger.grown or not set(source.columns) <= set(target.columns)
    written = write_load(spark, rows, ledger, run, keys)
    commit(spark, name, replace(written, files=(*ledger.files, *hit), grown=grown))
    return len(hit)
