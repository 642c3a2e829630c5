"""Model versions as an append-only table of events, folded to their current state.

An event says that a field of a version took a value (null: the field was withdrawn). Events come
in batches; a batch has a number, and the sequence of an event is its batch's number and its place
in it. A number is claimed by creating a file that must not exist, after the state was read: two
writers that saw the same state cannot both go on, the second one is refused and has to read
again. A claim whose batch was never written is a gap that nobody needs.

The state is an aggregate with a map-side half, one row per (version, field).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.publish import append_rows, read_log

EVENTS = "version_events"
CLAIMS = "version_claims"
EVENT_SCHEMA = "version string, field string, value string, event_ts timestamp_ntz, seq bigint"
#: Events that a batch may hold.
BATCH = 1 << 20
#: What may follow what; a version without a status is new.
MOVES: dict[str | None, tuple[str, ...]] = {
    None: ("challenger", "champion"),
    "challenger": ("champion", "archived"),
    "champion": ("archived",),
    "archived": ("champion",),
}

Change = tuple[str, str, str | None]


class StaleState(RuntimeError):
    """Somebody else wrote events since the state was read."""


class IllegalMove(ValueError):
    """A version cannot go from its status to the wanted one."""


def events(spark: SparkSession, root: str) -> DataFrame:
    return read_log(spark, root, EVENTS, EVENT_SCHEMA)


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def head(spark: SparkSession, root: str) -> int:
    """Number of the newest claimed batch, -1 if there is none."""
    path, files = _files(spark, f"{root}/{CLAIMS}")
    if not files.exists(path):
        return -1
    return max((int(entry.getPath().getName()) for entry in files.listStatus(path)), default=-1)


def claim(spark: SparkSession, root: str, number: int) -> None:
    """Claim a batch number; raises :class:`StaleState` if it is taken."""
    folder, files = _files(spark, f"{root}/{CLAIMS}")
    files.mkdirs(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}")
    try:
        if files.getScheme() == "file":
            # The local file system checks and creates in two steps; the platform does it in one.
            local = spark._jvm.java.io.File(path.toUri().getPath())
            made = local.createNewFile()
        else:
            files.create(path, False).close()
            made = True
    except Py4JJavaError as error:
        if "AlreadyExists" not in str(error.java_exception):
            raise
        made = False
    if not made:
        raise StaleState(f"batch {number} under {root} was claimed by another writer; read the state again")


def record(spark: SparkSession, root: str, changes: Sequence[Change], seen: int) -> int:
    """Append changes (version, field, value) that follow from the state of batch ``seen``.

    All of them become visible by one file. Returns the new batch's number."""
    if not 0 < len(changes) <= BATCH:
        raise ValueError(f"a batch holds 1 to {BATCH} changes, got {len(changes)}")
    claim(spark, root, seen + 1)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(v, f, None if value is None else str(value), now, (seen + 1) * BATCH + i) for i, (v, f, value) in enumerate(changes)]
    append_rows(spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1), root, EVENTS)
    return seen + 1


def state(log: DataFrame) -> DataFrame:
    """version, field and current value; withdrawn fields are left out."""
    newest = log.groupBy("version", "field").agg(F.max_by(F.struct("value"), "seq").alias("at"))
    return newest.select("version", "field", "at.value").where(F.col("value").isNotNull())


def holders(log: DataFrame) -> DataFrame:
    """alias and the version that answers to it; an alias that was taken away has no row.

    ``alias:<name>`` events carry the holder's right to the name ("held") or its loss (null); the
    newest event of a name decides, so a name never has two holders.
    """
    moves = log.where(F.col("field").startswith("alias:"))
    newest = moves.groupBy(F.expr("substring(field, 7)").alias("alias")).agg(F.max_by(F.struct("version", "value"), "seq").alias("at"))
    return newest.where(F.col("at.value").isNotNull()).select("alias", F.col("at.version").alias("version"))


def described(log: DataFrame, tags: Sequence[str]) -> DataFrame:
    """One row per version with its current tags, status and aliases."""
    wide = state(log).groupBy("version").pivot("field", list(tags)).agg(F.first("value"))
    held = holders(log).groupBy("version").agg(F.array_join(F.array_sort(F.collect_set("alias")), ",").alias("aliases"))
    return log.select("version").distinct().join(wide, "version", "left").join(held, "version", "left").fillna("", ["aliases"])


def moves(log: DataFrame, version: str, to: str, reason: str | None = None) -> list[Change]:
    """The changes that take a version to another status, the alias of the old and new one with it."""
    row = state(log).where((F.col("version") == version) & (F.col("field") == "status")).first()
    now = row["value"] if row else None
    if to not in MOVES.get(now, ()):
        raise IllegalMove(f"version {version} is {now or 'new'} and cannot become {to}")
    out: list[Change] = [(version, "status", to)]
    if now in ("challenger", "champion"):
        # A name that went to another version meanwhile is not taken from it.
        if holders(log).where((F.col("alias") == now) & (F.col("version") == version)).count():
            out.append((version, f"alias:{now}", None))
    if to in ("challenger", "champion"):
        out += [(version, f"alias:{to}", "held"), (version, "withdrawn_reason", None)]
    if to == "archived":
        out.append((version, "withdrawn_reason", reason))
    return out


def resolve(log: DataFrame, reference: str) -> str:
    """``@alias``, a pinned version number, or a path, to the version or path to load."""
    if reference.startswith("@"):
        row = holders(log).where(F.col("alias") == reference[1:]).first()
        if row is None:
            raise LookupError(f"no version answers to {reference}")
        return row["version"]
    if "/" in reference or not log.where(F.col("version") == reference).isEmpty():
        return reference
    raise LookupError(f"{reference!r} is neither an alias, a version nor a path")


def transitions(log: DataFrame) -> DataFrame:
    """seq, version, before, after and legal of every change of a status, in the table's own order."""
    each = Window.partitionBy("version").orderBy("seq")
    steps = log.where(F.col("field") == "status").select("seq", "version", F.lag("value").over(each).alias("before"), F.col("value").alias("after"))
    legal = F.lit(False)
    for before, allowed in MOVES.items():
        legal = legal | (F.col("before").eqNullSafe(F.lit(before)) & F.col("after").isin(list(allowed)))
    return steps.withColumn("legal", legal)
