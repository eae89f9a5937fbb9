"""The composed jobs: profile, clean, star, aggregates, validation, and all of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayside.config import DEFAULT, SENSOR_COLS, Settings, cleaner_gate_rules
from wayside.functions.numeric import percent, ratio
from wayside.functions.temporal import minutes_between
from wayside.operators import aggregates as agg
from wayside.operators.cleaning import (
    add_duration,
    clip,
    drop_outside_domain,
    filter_years,
    impute_constant,
    impute_median,
    present,
    with_timestamps,
)
from wayside.operators.features import (
    add_high_severity,
    add_infra_score,
    add_location_key,
    add_time_features,
    add_weather_features,
)
from wayside.operators.profiling import duplicate_count, range_profile, top_missing
from wayside.operators.reconcile import (
    check_aggregates,
    quality_report,
    reconcile_city,
    reconcile_totals,
    reconcile_weather,
    recount,
)
from wayside.operators.rules import (
    check_keys,
    check_quality,
    check_rules,
    check_star,
    quality_measures,
    raise_failures,
    rule_measures,
    watch,
)
from wayside.operators.star import (
    DIMENSIONS,
    Star,
    build_dimensions,
    build_fact,
)
from wayside.session import materialize, scratch_removed
from wayside.sources.publish import Publication
from wayside.sources.tables import (
    BAD_RECORD,
    bad_records,
    clustered,
    read_incidents,
    read_star,
    read_table,
    star_of,
    star_paths,
)


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """Temporal, geographic, severity and quality profile of the raw rows.

    The five count tables come from one pass over the rows.
    """
    df = with_timestamps(df)
    if "Duration_min" not in df.columns:
        df = df.withColumn("Duration_min", minutes_between("Start_Time", "End_Time"))
    df = df.withColumns({"Year": F.year("Start_Time"), "Hour": F.hour("Start_Time")})
    sets = {
        "by_year": ("Year",),
        "top_hours": ("Hour",),
        "top_states": ("State",),
        "top_cities": ("State", "City"),
        "severity": ("Severity",),
    }
    counts = agg.by_sets(
        df,
        sets,
        [
            F.count(F.lit(1)).alias("count"),
            F.count("ID").alias("n_id"),
            F.count("Duration_min").alias("n_dur"),
            F.sum("Duration_min").alias("sum_dur"),
        ],
    )

    def by(name: str) -> DataFrame:
        known = reduce(lambda d, c: d.where(F.col(c).isNotNull()), sets[name], counts[name])
        return known.select(*sets[name], "count")

    def top(n: int, name: str) -> DataFrame:
        return by(name).orderBy(F.col("count").desc(), *sets[name]).limit(n)

    return {
        "by_year": by("by_year"),
        "top_hours": top(5, "top_hours"),
        "top_states": top(10, "top_states"),
        "top_cities": top(10, "top_cities"),
        "severity": counts["severity"]
        .where(F.col("Severity").isNotNull())
        .select(
            "Severity",
            F.col("n_id").alias("count"),
            ratio("sum_dur", "n_dur").alias("avg_duration_min"),
        ),
        "missing": top_missing(df, 10),
        "duplicate_ids": duplicate_count(df, ["ID"]),
        "ranges": range_profile(df, present(df, SENSOR_COLS)),
    }


def clean(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The cleaned table with all derived columns.

    Medians are taken before capping and before rows with an invalid severity go. They
    need a pass of their own over the rows, which a plan without sensor columns drops.
    """
    filled = impute_constant(impute_median(with_timestamps(df), SENSOR_COLS), settings.fill_values)
    for c, lo, hi in (
        ("Temperature(F)", settings.temp_min, settings.temp_max),
        ("Visibility(mi)", settings.visibility_min, settings.visibility_max),
    ):
        if c in filled.columns:
            filled = clip(filled, c, lo, hi)
    kept = drop_outside_domain(filled, "Severity", settings.severities)
    timed = add_time_features(add_duration(kept, hi=settings.duration_max_min))
    scored = add_high_severity(add_infra_score(add_weather_features(timed, settings)), settings)
    return add_location_key(scored, settings)


def clean_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows in, rows out, rows removed and their share."""
    n_in = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    out = after.agg(F.count(F.lit(1)).alias("rows_out")).withColumn("rows_in", n_in)
    return out.select(
        "rows_in",
        "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("rows_removed"),
        percent(F.col("rows_in") - F.col("rows_out"), "rows_in").alias("removed_pct"),
    )


def build_star(
    df: DataFrame,
    settings: Settings = DEFAULT,
    dims: Sequence[str] = DIMENSIONS,
    verify: bool = True,
) -> Star:
    """Three dimensions and the fact of a cleaned table.

    The dimensions come from one pass over the rows, which runs at once and is
    kept; ``dims`` names the wanted ones. The fact stays lazy. A star with all dimensions
    is verified (keys unique, no orphans, durations capped) and must pass.
    """
    built = build_dimensions(df, settings, dims)
    star = Star(accident_detail=build_fact(df, built.get("dim_weather"), settings), **built)
    if verify and len(built) == len(DIMENSIONS):
        verify_star(star, settings)
    return star


def verify_star(star: Star, settings: Settings = DEFAULT) -> None:
    """Raise with the failing findings on keys, orphans and durations."""
    raise_failures(check_keys(star).unionByName(check_star(star, settings)))


def build_aggregates(star: Star, settings: Settings = DEFAULT) -> dict[str, DataFrame]:
    """The five dashboards from one pass over the fact."""
    rolled = agg.star_rollups(star, settings=settings)
    make = {
        "agg_federal": agg.agg_federal,
        "agg_state_anomaly": agg.agg_state_anomaly,
        "agg_city_by_state": agg.agg_city_by_state,
        "agg_weather_by_state": agg.agg_weather_by_state,
        "agg_time_pattern": agg.agg_time_pattern,
    }
    return {name: f(rolled[name], settings) for name, f in make.items()}


def verify_aggregates(aggs: Mapping[str, DataFrame]) -> None:
    """Raise if a share is no share, or clear weather is not its own baseline."""
    raise_failures(check_aggregates(aggs))


def validate_outputs(
    base: DataFrame,
    aggs: Mapping[str, DataFrame],
    settings: Settings = DEFAULT,
    pairs: Sequence[tuple[str, str]] | None = None,
    states: Sequence[str] | None = None,
    quality: DataFrame | None = None,
) -> DataFrame:
    """All findings on the aggregates and the cleaned rows.

    The rows are read once, for the three reconciliations and the quality checks; the
    measures of the latter may be given as ``quality``. All groups are compared, or the
    sample ``pairs`` of state and city and the sample ``states``.
    """
    counts = recount(base, settings, more=() if quality else quality_measures(base, settings))
    parts = [
        reconcile_city(
            aggs["agg_city_by_state"], counts["city"], pairs, states, settings=settings
        ),
        reconcile_weather(
            aggs["agg_weather_by_state"], counts["weather"], states, settings=settings
        ),
        reconcile_totals(
            {
                "agg_federal": aggs["agg_federal"],
                "agg_city_by_state": aggs["agg_city_by_state"],
                "agg_weather_by_state": aggs["agg_weather_by_state"],
            },
            counts["city"],
        ),
        check_quality(base, settings, quality or counts["all"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def at_once(tasks: Sequence[Callable[[], None]], threads: int = 4) -> None:
    """Run independent small Spark jobs side by side; the first error is raised."""
    with ThreadPoolExecutor(threads) as pool:
        for done in [pool.submit(copy_context().run, task) for task in tasks]:
            done.result()


@dataclass(frozen=True)
class EtlResult:
    cleaned: DataFrame
    star: Star
    aggregates: dict[str, DataFrame]
    findings: DataFrame
    report: DataFrame


def run_etl(
    spark: SparkSession,
    source: str,
    out: str,
    settings: Settings = DEFAULT,
    fmt: str = "csv",
    with_profile: bool = True,
    multi_line: bool = False,
    keep_ids: bool = False,
    cluster: bool = False,
) -> EtlResult:
    """Load, profile, clean, star, aggregates, validation; every stage is written.

    The source is parsed once. Each stage reads the written tables of the one before, so
    a lost executor costs a retry within a stage, and table sizes are known when Spark
    plans joins. Every table is written once, to a staging folder below ``out``; when all
    are there and checked, they replace those of an earlier run together (see
    ``publish``), and a run that fails leaves those. Null counts, ranges and domains are
    checked on the rows as they are written. The number of unreadable records is in
    ``profile/bad_records``. With ``keep_ids`` weather texts that an earlier run below ``out``
    has numbered keep their ids. With ``cluster`` the cleaned rows and the fact are written
    in ranges of the start time, at the price of a shuffle each; the rows of one year then
    are in few files. Scratch tables go at the end, also after an error.
    """
    out = out.rstrip("/")
    with scratch_removed(spark), Publication(spark, out) as new:
        known = star_paths(out)["dim_weather"]
        kept = read_table(spark, known) if keep_ids and new.files.exists(known) else None
        _run_etl(new, source, settings, fmt, with_profile, multi_line, kept, clustered if cluster else None)
    names = [path.removeprefix(f"{out}/aggregates/") for path in new.staged if "/aggregates/" in path]
    return EtlResult(
        read_table(spark, f"{out}/cleaned"),
        read_star(spark, out),
        {name: read_table(spark, f"{out}/aggregates/{name}") for name in names},
        read_table(spark, f"{out}/quality/findings"),
        read_table(spark, f"{out}/quality/report"),
    )


def _run_etl(
    new: Publication,
    source: str,
    settings: Settings,
    fmt: str,
    with_profile: bool,
    multi_line: bool,
    kept_weather: DataFrame | None,
    laid_out: Callable[[DataFrame], DataFrame] | None,
) -> None:
    spark, out = new.spark, new.root
    parsed = materialize(read_incidents(spark, source, fmt, multi_line, keep_bad=True))
    raw = filter_years(parsed.drop(BAD_RECORD), settings.start_year, settings.end_year)
    about = {"bad_records": bad_records(parsed), "summary": agg.summary(raw)}
    if with_profile:
        about |= profile(raw)
    at_once([partial(new.write, table, f"{out}/profile/{name}") for name, table in about.items()])

    laid_out = laid_out or (lambda df: df)
    checked, rules = laid_out(clean(raw, settings)), cleaner_gate_rules(settings)
    measures = [*rule_measures(checked, rules), *quality_measures(checked, settings)]
    watched, measured = watch(checked, measures)
    cleaned = new.write(watched, f"{out}/cleaned")
    raise_failures(check_rules(checked, "cleaner", rules, measured=measured()))

    paths = star_paths(out)

    def write(tables: Mapping[str, DataFrame], path_of: Callable[[str], str]) -> dict[str, DataFrame]:
        staged: dict[str, DataFrame] = {}

        def one(name: str) -> None:
            staged[name] = new.write(agg.sort_output(name, tables[name]), path_of(name))

        at_once([partial(one, name) for name in tables])
        return staged

    dims = write(build_dimensions(cleaned, settings, kept_weather=kept_weather), paths.get)
    fact = laid_out(build_fact(cleaned, dims["dim_weather"], settings))
    fact = new.write(fact, paths["accident_detail"])
    star = star_of({"accident_detail": fact, **dims})
    on_star = materialize(check_star(star, settings))
    raise_failures(check_keys(star).unionByName(on_star))

    aggs = write(build_aggregates(star, settings), lambda name: f"{out}/aggregates/{name}")
    verify_aggregates(aggs)

    on_outputs = validate_outputs(cleaned, aggs, settings, quality=measured())
    findings = new.write(on_star.unionByName(on_outputs), f"{out}/quality/findings")
    new.write(quality_report(findings), f"{out}/quality/report")
