"""Daily files to facts: landed CSV -> silver -> checked -> gold, for a day, a range, or what changed.

Layout under a base URI: ``raw/events/dt=...`` (CSV), and ``silver/events`` and ``gold/events``
(Parquet) in folders ``attempt=.../dt=...``. Every run writes an attempt of its own; the commits in
``published`` say which attempt of each day counts. One commit switches all days and both layers, so
readers (`published`) see a run whole or not at all, and a run that fails or dies changes nothing.
"""

import logging
import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from studymart.contracts import DAY, EVENT_SCHEMA, REJECTS
from studymart.operators import marts
from studymart.operators.marts import fct_event_rates
from studymart.operators.quality import (
    EVENT_RULES,
    QualityGateError,
    applicable,
    readable,
    require_counts,
    violation_counts,
)
from studymart.operators.staging import bronze_to_silver
from studymart.session import materialise
from studymart.sources.commits import CommitConflict, CommitLog, folder_names, remove
from studymart.sources.files import (
    MissingInput,
    day_path,
    landed_days,
    scan_csv_text,
    scan_parquet,
    typed,
    undated,
    write_days,
)
from studymart.sources.ledger import FILE_SCHEMA, LOAD, Ledger, batches, list_files, new_load

#: What silver is counted against while it is written.
SILVER_RULES = (*EVENT_RULES, readable(REJECTS))

log = logging.getLogger(__name__)


def _as_date(day: date | str) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def folder(base: str, layer: str) -> str:
    return f"{base.rstrip('/')}/{layer}/events"


def _attempt(base: str, layer: str, attempt: str) -> str:
    return f"{folder(base, layer)}/attempt={attempt}"


def _log(spark: SparkSession, base: str) -> CommitLog:
    return CommitLog(spark, f"{base.rstrip('/')}/published")


def published_days(spark: SparkSession, base: str, layer: str) -> dict[date, str | None]:
    """The published days of a layer and their attempts; None where a day has no rows."""
    _, state = _log(spark, base).latest()
    return {date.fromisoformat(d): entry["attempt"] for d, entry in state.get(layer, {}).items()}


def published(
    spark: SparkSession, base: str, layer: str, start: date | str = date.min, end: date | str = date.max
) -> DataFrame:
    """The rows of a layer as last published, of an inclusive range of days.

    Only the folders of those days are read. The frame keeps reading what was published when it was
    made, for as long as `vacuum` keeps that.
    """
    root, first, last = folder(base, layer), _as_date(start), _as_date(end)
    days = published_days(spark, base, layer)
    full = [(d, day_path(_attempt(base, layer, a), d)) for d, a in sorted(days.items()) if a]
    paths = [path for d, path in full if first <= d <= last]
    if not days:
        raise MissingInput(f"{root} has nothing published")
    if not full:
        return spark.read.parquet(_empty(base, layer))
    if not paths:
        return scan_parquet(spark, full[0][1], base_path=root).drop("attempt").limit(0)
    return scan_parquet(spark, paths, base_path=root).drop("attempt")


def _empty(base: str, layer: str) -> str:
    return f"{base.rstrip('/')}/{layer}/empty"


def _publish(spark: SparkSession, base: str, changes: dict[str, dict[date, dict]], since: int) -> None:
    """Commit changed days; a commit of the same days by another run since version ``since`` wins."""
    log_ = _log(spark, base)
    while True:
        version, state = log_.latest()
        for seen in range(since + 1, version + 1):
            meanwhile = log_.read(seen)["changed"]
            if any(d.isoformat() in meanwhile.get(layer, ()) for layer, days in changes.items() for d in days):
                raise CommitConflict(f"another run published days of {base} meanwhile")
        content = {layer: dict(state.get(layer, {})) for layer in ("silver", "gold")}
        for layer, days in changes.items():
            content[layer].update({d.isoformat(): entry for d, entry in days.items()})
        content["changed"] = {layer: [d.isoformat() for d in days] for layer, days in changes.items()}
        try:
            log_.commit(version + 1, content)
            return
        except CommitConflict:
            continue  # another run took the number: look what it changed


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Remove days that none of the last ``keep`` commits counts; leave it out while a run is going on."""
    log_ = _log(spark, base)
    versions = log_.versions()[-keep:]
    states = [log_.read(v) for v in versions]
    for layer in ("silver", "gold"):
        used = {(e["attempt"], d) for s in states for d, e in s[layer].items() if e["attempt"]}
        for name in folder_names(spark, folder(base, layer)):
            if not name.startswith("attempt="):
                continue
            attempt, path = name.removeprefix("attempt="), f"{folder(base, layer)}/{name}"
            days = [n for n in folder_names(spark, path) if n.startswith(f"{DAY}=")]
            unused = [d for d in days if (attempt, d.removeprefix(f"{DAY}=")) not in used]
            for day in [None] if len(unused) == len(days) else unused:
                remove(spark, f"{path}/{day}" if day else path)


def write_silver(spark: SparkSession, base: str, days: list[date], attempt: str) -> dict:
    """Type and normalise landed days into an attempt; return the rule counts and the days with rows.

    A row-wise pass without a shuffle: the input is foldered by day, so each task holds few
    days. The quality rules are counted by the same pass, not by another scan. Each row lists its
    unreadable columns, a malformed line as such, in a column of its own.
    """
    root = folder(base, "raw")
    text = scan_csv_text(spark, [day_path(root, d) for d in days], base_path=root)
    silver = bronze_to_silver(typed(text, EVENT_SCHEMA, rejects=REJECTS))
    seen = Observation("silver")
    counted = silver.observe(
        seen,
        *violation_counts(applicable(silver, SILVER_RULES)),
        F.collect_set(F.col(DAY).cast("string")).alias("days"),
    )
    write_days(counted, _attempt(base, "silver", attempt))
    counts = dict(seen.get)
    counts["days"] = {date.fromisoformat(d) for d in counts["days"]}
    if not counts["days"]:
        silver.limit(0).write.mode("overwrite").parquet(_empty(base, "silver"))
    return counts


def write_gold(spark: SparkSession, base: str, days: list[date], attempt: str) -> None:
    """Event rates of those silver days of an attempt that have rows."""
    root = _attempt(base, "silver", attempt)
    silver = scan_parquet(spark, [day_path(root, d) for d in days], base_path=root)
    rates = fct_event_rates(silver, "event_type_norm", (DAY, "study_id", "event_date"))
    write_days(rates, _attempt(base, "gold", attempt), rebalance=True)


def _landed(spark: SparkSession, base: str, start, end, missing_ok: bool, undated_ok: bool) -> list[date]:
    loose = undated(spark, folder(base, "raw"))
    if loose and not undated_ok:
        raise QualityGateError([("dated", DAY, scan_csv_text(spark, loose).count())])
    first, last = _as_date(start), _as_date(end)
    days = landed_days(spark, folder(base, "raw"), first, last)
    missing = (last - first).days + 1 - len(days)
    if missing and not missing_ok:
        wanted = (first + timedelta(n) for n in range((last - first).days + 1))
        raise MissingInput("no landed events for " + ", ".join(str(d) for d in wanted if d not in set(days)))
    if missing:
        log.warning("no landed events for %d of %d days", missing, missing + len(days))
    return days


def backfill(
    spark: SparkSession,
    base: str,
    start: date | str,
    end: date | str,
    missing_ok: bool = False,
    unreadable_ok: bool = False,
    undated_ok: bool = False,
) -> None:
    """Process every day of an inclusive range in one pass over all of them.

    Write, audit, publish: silver goes to an attempt and its rules are counted by that write; only if
    none is broken is gold built, and one commit then publishes both. Days are replaced, so a rerun
    gives the same tables. A day without a landed folder stops the run, or is left out with
    ``missing_ok``. Broken rules stop it, and what was published stays; so do unreadable values and
    malformed lines, unless they are let through as NULL with ``unreadable_ok``, and a folder of rows
    without a day, which belongs to no range, unless it is to be left out with ``undated_ok``. The
    error names the attempt, which stays for inspection until `vacuum`.
    """
    days = _landed(spark, base, start, end, missing_ok, undated_ok)
    if not days:
        return
    since, attempt = _log(spark, base).latest()[0], uuid.uuid4().hex
    counts = write_silver(spark, base, days, attempt)
    try:
        require_counts(EVENT_RULES if unreadable_ok else SILVER_RULES, counts)
    except QualityGateError as error:
        error.attempt = _attempt(base, "silver", attempt)
        raise
    full = sorted(counts["days"])
    if full:
        write_gold(spark, base, full, attempt)
    else:
        silver = spark.read.parquet(_empty(base, "silver"))
        rates = fct_event_rates(silver, "event_type_norm", (DAY, "study_id", "event_date"))
        rates.write.mode("overwrite").parquet(_empty(base, "gold"))
    entries = {d: {"attempt": attempt if d in counts["days"] else None} for d in days}
    _publish(spark, base, {"silver": entries, "gold": entries}, since)


# --- Changed days only ----------------------------------------------------------


def _file_day(path: Column) -> Column:
    return F.to_date(F.regexp_extract(path, f"/{DAY}=([0-9-]+)/", 1))


def _file_states(found: DataFrame) -> dict[date, str]:
    """A digest of the files of each landed day: their paths, lengths and times of change."""
    file = F.xxhash64("path", "length", "changed_at")
    digests = found.groupBy(DAY).agg(F.count("*").alias("n"), F.bit_xor(file).alias("x"))
    return {r[DAY]: f"{r['n']}-{r['x']}" for r in digests.collect()}


def refresh(spark: SparkSession, base: str, unreadable_ok: bool = False, files_per_load: int = 10_000) -> list[date]:
    """Bring gold up to date with the landed files and return the days that were built anew.

    Each landed file is read once in its life: what it adds to gold, counts and sums by study and
    date, is kept by file (`states`). A late, changed or removed file changes the digest of its day;
    gold of those days is merged from the states of the files that lie there now. Equal to a
    `backfill` of all days, up to the order in which durations add up. Rules are as there, counted
    file by file before a state counts.
    """
    raw, ledger = folder(base, "raw"), Ledger(spark, folder(base, "states"), apart=True)
    found = materialise(list_files(spark, raw).withColumn(DAY, _file_day(F.col("path"))), "landed_files")
    if not found.where(F.col(DAY).isNull()).isEmpty():
        raise QualityGateError([("dated", DAY, found.where(F.col(DAY).isNull()).count())])
    for batch in batches(ledger.unloaded(found.drop(DAY)), files_per_load, "append"):
        _load_states(spark, ledger, batch, unreadable_ok)

    since, state = _log(spark, base).latest()
    built = {d: e.get("files") for d, e in state.get("gold", {}).items()}
    now = _file_states(found)
    gone = [date.fromisoformat(d) for d in built if date.fromisoformat(d) not in now]
    days = sorted(d for d, digest in now.items() if built.get(d.isoformat()) != digest)
    if not days and not gone:
        return []
    attempt, filled = uuid.uuid4().hex, set()
    if days:
        # A changed file has several states: the last load of it counts.
        order = ledger.commits().select(LOAD, "version")
        loads = ledger.files().join(found.where(F.col(DAY).isin(days)), ["path", "length", "changed_at"])
        latest = loads.join(order, LOAD).groupBy("path").agg(F.max_by(LOAD, "version").alias(LOAD))
        states = spark.read.option("basePath", ledger.root).parquet(f"{ledger.root}/{LOAD}=*")
        states = states.where(F.col(DAY).isin(days)).join(latest, ["path", LOAD], "left_semi")
        gold = marts.rates_of_states(states, (DAY, "study_id", "event_date"))
        target = _attempt(base, "gold", attempt)
        write_days(gold, target, rebalance=True)
        filled = {n.removeprefix(f"{DAY}=") for n in folder_names(spark, target) if n.startswith(f"{DAY}=")}
        if not filled:
            gold.limit(0).write.mode("overwrite").parquet(_empty(base, "gold"))
    entries = {d: {"attempt": attempt if d.isoformat() in filled else None, "files": now[d]} for d in days}
    entries |= {d: {"attempt": None} for d in gone}
    _publish(spark, base, {"gold": entries}, since)
    return sorted([*days, *gone])


def _load_states(spark: SparkSession, ledger: Ledger, batch: list, unreadable_ok: bool) -> None:
    """The states of some files, by file, committed together with the files."""
    load = new_load()
    text = scan_csv_text(spark, [r.path for r in batch]).select("*", F.col("_metadata.file_path").alias("path"))
    silver = bronze_to_silver(typed(text, EVENT_SCHEMA, rejects=REJECTS))
    # The listing's paths are plain, those of rows are URIs.
    silver = silver.withColumn("path", F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))))
    silver = silver.withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
    seen = Observation(load)
    counted = silver.observe(seen, *violation_counts(applicable(silver, SILVER_RULES)))
    keys = ("path", "study_id", "event_date")
    states = marts.rate_states(counted, "event_type_norm", keys).withColumn(DAY, _file_day(F.col("path")))
    states.write.mode("overwrite").parquet(ledger.staged(load))
    try:
        require_counts(EVENT_RULES if unreadable_ok else SILVER_RULES, seen.get)
    except QualityGateError:
        remove(spark, ledger.staged(load))
        raise
    ledger.commit(load, spark.createDataFrame(batch, FILE_SCHEMA), "refresh")


def run_day(spark: SparkSession, base: str, day: date | str, missing_ok: bool = False) -> None:
    """`backfill` for one day."""
    backfill(spark, base, day, day, missing_ok)


def backfill_calendar(events: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Every day of an inclusive range with its number of event rows, 0 for an empty day."""
    first, last = (F.to_date(F.lit(str(d))) for d in (start, end))
    day = F.col("event_date")
    per_day = (
        events.where(day.between(first, last)).groupBy(day.alias("day")).agg(F.count("*").alias("rows"))
    )
    calendar = events.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.sequence(first, last)).alias(DAY)
    )
    return calendar.join(per_day, F.col(DAY) == F.col("day"), "left").select(
        DAY, F.coalesce("rows", F.lit(0)).alias("event_rows")
    )
