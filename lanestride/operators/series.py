"""Features of ``(series, t, value)`` data: energy, onsets, tempo, beats, sections.

Energy rows are ``(series, idx, t, value)`` with a dense ``idx``; neighbour
rules run in index chunks with a halo, so a series of any length is spread.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lanestride.functions.columns import half_even
from lanestride.operators.greedy import min_gap
from lanestride.operators.spread import attach_dense, count_up, halo, neighbours, ordered_index
from lanestride.session import stage

S = "series"


def rms_by_index(samples: DataFrame, rate: Column, window_seconds: float = 0.1) -> DataFrame:
    """Tumbling RMS over ``(series, idx, sample)``; a short tail window is kept."""
    size = F.greatest(F.lit(1), F.floor(rate * window_seconds).cast("bigint"))
    return (samples.withColumn("_size", size).withColumn("_rate", rate)
            .groupBy(S, F.floor(F.col("idx") / F.col("_size")).alias("w"))
            .agg(F.sqrt(F.avg(F.col("sample") * F.col("sample"))).alias("value"),
                 F.min("_size").alias("_size"), F.min("_rate").alias("_rate"))
            .select(S, F.col("w").cast("bigint").alias("idx"), (F.col("w") * F.col("_size") / F.col("_rate")).alias("t"), "value"))


def rms_by_time(points: DataFrame, width: float, spacing: float | None = None) -> DataFrame:
    """Tumbling RMS over time cells of ``width``; ``t`` is cell time, or idx * ``spacing``."""
    cells = (points.groupBy(S, F.floor(F.col("t") / width).cast("bigint").alias("cell"))
                   .agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("value")))
    dense = ordered_index(cells, [S], F.floor(F.col("cell") / 4096), ["cell"], "idx")
    at = F.col("cell") * F.lit(float(width)) if spacing is None else F.col("idx") * F.lit(float(spacing))
    return dense.select(S, F.col("idx").cast("bigint").alias("idx"), at.alias("t"), "value")


def minmax_normalise(energy: DataFrame) -> DataFrame:
    facts = energy.groupBy(S).agg(F.count(F.lit(1)).alias("_n"), F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    span = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-9))
    return (attach_dense(energy, facts, S, "_n", "idx")
            .withColumn("value", (F.col("value") - F.col("_lo")) / span).drop("_n", "_lo", "_hi"))


def smooth3(energy: DataFrame) -> DataFrame:
    """Centred mean of three, shrinking at the ends.  Series under three points stay as they are."""
    near = halo(energy, "idx", 1, 1)
    w = W.partitionBy(S, "_chunk").orderBy("idx")
    three = w.rowsBetween(-1, 1)
    # A series shorter than three has idx 0 and 1 only, and then row idx 2 is absent.
    tiny = (F.col("idx") < 2) & (F.max("idx").over(w.rowsBetween(-1, 2)) < 2)
    return (near.withColumn("_s", F.when(tiny, F.col("value")).otherwise(F.avg("value").over(three)))
                .where("_own").select(S, "idx", "t", F.col("_s").alias("value")))


def onset_candidates(energy: DataFrame, floor: float = 0.08, factor: float = 1.15, min_points: int = 4) -> DataFrame:
    """Points whose rise reaches max(floor, mean + factor * population deviation) of all rises."""
    w = W.partitionBy(S, "_chunk").orderBy("idx")
    rises = (halo(energy, "idx", 1, 0)
             .withColumn("delta", F.greatest(F.lit(0.0), F.col("value") - F.lag("value").over(w)))
             .withColumn("_prior", F.lag("idx").over(w))
             .where(F.col("_own") & F.col("_prior").isNotNull()).select(S, "idx", "t", "delta"))
    facts = rises.groupBy(S).agg((F.count(F.lit(1)) + 1).alias("_n"), F.avg("delta").alias("_m"), F.stddev_pop("delta").alias("_d"))
    threshold = F.greatest(F.lit(floor), F.col("_m") + F.col("_d") * factor)
    return (attach_dense(rises, facts, S, "_n", "idx")
            .where((F.col("_n") >= min_points) & (F.col("delta") >= threshold)).select(S, "idx", "t", "delta"))


def gaps(positions: DataFrame, keys: Sequence[str], place: str, block: float) -> DataFrame:
    """Distance to the previous position of the same key (``gap``), first rows omitted."""
    keys = list(keys)
    dense = ordered_index(positions, keys, F.floor(F.col(place) / block), [place], "_i")
    w = W.partitionBy(*keys, "_chunk").orderBy("_i")
    return (halo(dense, "_i", 1, 0).withColumn("gap", F.col(place) - F.lag(place).over(w))
            .where(F.col("_own") & F.col("gap").isNotNull()).select(*keys, place, "gap"))


def fold_octave(bpm: Column, low: float = 80.0, high: float = 210.0) -> Column:
    """Double or halve into the range, then round half-even."""
    up = F.aggregate(F.sequence(F.lit(1), F.lit(64)), bpm, lambda b, i: F.when(b < low, b * 2.0).otherwise(b))
    down = F.aggregate(F.sequence(F.lit(1), F.lit(64)), up, lambda b, i: F.when(b > high, b / 2.0).otherwise(b))
    return half_even(F.greatest(F.lit(low), F.least(F.lit(high), down)))


def best_lag(energy: DataFrame, spacing: float = 0.1, shortest: float = 0.25, longest: float = 1.2,
             min_points: int = 20) -> DataFrame:
    """Lag with the largest mean v[i] * v[i - lag]; ties to the smaller lag; ``bpm`` from it.

    The lag range is fixed by ``spacing``, so all lags are read from one chunked
    window whose halo is the longest lag.
    """
    step = max(spacing, 0.1)
    lags = list(range(max(2, int(shortest / step)), max(3, int(longest / step))))
    near = halo(energy, "idx", max(lags), 0)
    w = W.partitionBy(S, "_chunk").orderBy("idx")
    for k in lags:
        near = near.withColumn(f"_p{k}", F.col("value") * F.lag("value", k).over(w))
    scores = near.where("_own").groupBy(S).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(f"_p{k}").alias(f"_p{k}") for k in lags])
    ranked = F.array_max(F.array(*[F.struct(F.coalesce(F.col(f"_p{k}"), F.lit(0.0)).alias("score"), F.lit(-k).alias("neg")) for k in lags]))
    enough = F.col("_n") >= min_points
    return scores.withColumn("_b", ranked).select(
        S, F.when(enough, -F.col("_b.neg")).cast("bigint").alias("lag"),
        F.when(enough, F.col("_b.score")).alias("score"),
        F.when(enough, 60.0 / F.greatest(-F.col("_b.neg") * step, F.lit(1e-9))).otherwise(F.lit(120.0)).alias("bpm"))


def tempo(onsets: DataFrame, energy: DataFrame, spacing: float = 0.1, low: float = 0.24, high: float = 1.2) -> DataFrame:
    """BPM per series: median onset gap within [low, high], else autocorrelation.

    ``percentile`` merges value counts; gaps lie on the energy grid inside a
    fixed range, so the distinct values per series are few whatever its length.
    """
    between = gaps(onsets, [S], "t", 256.0).where((F.col("gap") >= low) & (F.col("gap") <= high))
    medians = between.groupBy(S).agg(F.percentile("gap", F.lit(0.5)).alias("_g"))
    lagged = best_lag(energy, spacing)
    return lagged.join(medians, S, "left").select(
        S, fold_octave(F.when(F.col("_g").isNotNull(), 60.0 / F.greatest(F.col("_g"), F.lit(1e-9))).otherwise(F.col("bpm"))).alias("bpm"))


def sample_durations(samples: DataFrame, rate: Column, spacing: float = 0.1) -> DataFrame:
    """Length of each sampled series, samples / rate, and its number of energy points of ``spacing`` seconds."""
    n = F.count(F.lit(1))
    window = F.greatest(F.lit(1), F.floor(F.max(rate) * spacing))
    return samples.groupBy(S).agg((n / F.max(rate)).alias("duration"), F.ceil(n / window).cast("bigint").alias("points"))


def durations(energy: DataFrame, spacing: float = 0.1) -> DataFrame:
    """Length of a series that is known by its energy points only; sampled series have ``sample_durations``."""
    return energy.groupBy(S).agg(((F.max("idx") + 1) * F.lit(spacing)).alias("duration"), F.count(F.lit(1)).alias("points"))


def beat_grid(tempos: DataFrame, onsets: DataFrame, lengths: DataFrame) -> DataFrame:
    """Beats at phase + k * interval up to duration + interval.

    The phase is the first onset moved back by whole intervals into (0, interval].
    """
    first = onsets.groupBy(S).agg(F.min("t").alias("_f"))
    interval = F.lit(60.0) / F.greatest(F.col("bpm"), F.lit(1))
    base = (tempos.join(lengths, S).join(first, S, "left")
            .withColumn("_i", interval).withColumn("_f", F.coalesce("_f", F.lit(0.0)))
            .withColumn("_p", F.greatest(F.lit(0.0), F.when(
                F.col("_f") > F.col("_i"), F.col("_f") - (F.ceil(F.col("_f") / F.col("_i")) - 1) * F.col("_i")).otherwise(F.col("_f")))))
    grid = count_up(base, F.floor((F.col("duration") + F.col("_i") - F.col("_p")) / F.col("_i")), "beat")
    return grid.select(S, "beat", (F.col("_p") + F.col("beat") * F.col("_i")).alias("t"))


def section_label(energy: Column) -> Column:
    return (F.when(energy >= 0.72, "drop").when(energy >= 0.48, "build").when(energy <= 0.22, "quiet").otherwise("steady"))


def sections(energy: DataFrame, lengths: DataFrame, count: int = 12) -> DataFrame:
    """Equal time slices with mean energy and label; an empty slice has mean 0.

    ``lengths`` has (series, duration, points).  A series without energy points
    is one steady section of at least a second.
    """
    none = F.coalesce(F.col("points"), F.lit(0)) == 0
    facts = lengths.select(S, "duration", "points", none.alias("_none"), F.greatest(F.lit(1), F.least(F.lit(count), F.coalesce("points", F.lit(0)))).alias("_c")).withColumn(
        "_w", F.greatest(F.col("duration") / F.col("_c"), F.lit(0.1)))
    guess = F.floor(F.col("t") / F.col("_w"))
    index = (F.when(F.col("t") < guess * F.col("_w"), guess - 1)
              .when(F.col("t") >= (guess + 1) * F.col("_w"), guess + 1).otherwise(guess))
    placed = (attach_dense(energy, facts.where("not _none"), S, "points", "idx")
              .withColumn("section", F.least(index, F.col("_c") - 1)).where(F.col("t") < F.col("duration")))
    means = placed.groupBy(S, "section").agg(F.avg("value").alias("_e"))
    grid = facts.withColumn("section", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_c").cast("bigint") - 1)))
    e = F.when(F.col("_none"), F.lit(0.35)).otherwise(F.coalesce(F.col("_e"), F.lit(0.0)))
    last = F.when(F.col("_none"), F.greatest(F.coalesce("duration", F.lit(0.0)), F.lit(1.0))).otherwise(F.col("duration"))
    return grid.join(means, [S, "section"], "left").select(
        S, "section", F.coalesce(F.col("section") * F.col("_w"), F.lit(0.0)).alias("start"),
        F.when(F.col("section") == F.col("_c") - 1, last).otherwise((F.col("section") + 1) * F.col("_w")).alias("end"),
        e.alias("energy"), section_label(e).alias("label"))


PAGE = 4096


def paged(rows: DataFrame, kind: str, order: str, page: int = PAGE, **fields: Column) -> DataFrame:
    """(series, kind, page, values): the rows of each series in order of their dense index, ``page`` of them in one array."""
    packed = F.struct(F.col(order).alias("n"), *[value.alias(name) for name, value in fields.items()])
    told = ", ".join(f"'{name}', v.{name}" for name in fields)
    return (rows.groupBy(S, F.floor(F.col(order) / page).cast("bigint").alias("page")).agg(F.array_sort(F.collect_list(packed)).alias("_v"))
            .select(S, F.lit(kind).alias("kind"), "page", F.expr(f"transform(_v, v -> named_struct({told}))").alias("values")))


def series_analysis(energy: DataFrame, lengths: DataFrame | None = None, spacing: float = 0.1, onset_gap: float = 0.16, page: int = PAGE) -> tuple[DataFrame, DataFrame]:
    """(reports, pages) of all series.

    A report is a row: duration, bpm, the numbers of beats, onsets and energy
    points, and the (at most twelve) sections with their start, end, energy and
    label.  ``pages`` holds the beats, onsets and energies themselves, as arrays of (t, value) of up to
    ``page`` entries, value being null but for energies; so a series of any
    length is rows of bounded size, and a short one a single array of each kind.

    ``lengths`` (``sample_durations``) are the true lengths, and may name series
    without energy; without it a length follows from the number of points.
    """
    energy = stage(energy.select(S, "idx", "t", "value"))
    lengths = durations(energy, spacing) if lengths is None else stage(lengths.select(S, "duration", "points"))
    onsets = stage(min_gap(onset_candidates(energy), [S], "t", onset_gap))
    known = lengths.select(S).join(energy.select(S).distinct(), S, "left_anti").select(S, fold_octave(F.lit(120.0)).alias("bpm"))
    bpm = stage(tempo(onsets, energy, spacing).unionByName(known))
    beats = stage(beat_grid(bpm, onsets, lengths))
    count = lambda rows, name: rows.groupBy(S).agg(F.count(F.lit(1)).alias(name))
    packed = sections(energy, lengths).groupBy(S).agg(F.array_sort(F.collect_list(
        F.struct("section", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), F.round("energy", 4).alias("energy"), "label"))).alias("sections"))
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    reports = (lengths.join(bpm, S).join(count(beats, "beats"), S, "left").join(count(onsets, "onsets"), S, "left").join(packed, S, "left")
               .select(S, F.round("duration", 3).alias("duration"), "bpm", zero("beats"), zero("onsets"), zero("points"), "sections"))
    numbered = ordered_index(onsets, [S], F.floor(F.col("t") / 256.0).cast("bigint"), ["t"], "idx")
    at, nothing = F.round("t", 3), F.lit(None).cast("double")
    pages = (paged(beats, "beats", "beat", page, t=at, value=nothing).unionByName(paged(numbered, "onsets", "idx", page, t=at, value=nothing))
             .unionByName(paged(energy, "energy", "idx", page, t=at, value=F.round("value", 4))))
    return reports, pages


def series_report(energy: DataFrame, spacing: float = 0.1, onset_gap: float = 0.16, lengths: DataFrame | None = None) -> DataFrame:
    """The reports of ``series_analysis``."""
    return series_analysis(energy, lengths, spacing, onset_gap)[0]


# -- nearest lookups ----------------------------------------------------------
def nearest_value(points: DataFrame, probes: DataFrame, keys: Sequence[str], place: str, value: str, width: float,
                  default: float = 0.35) -> DataFrame:
    """Value of the closest point per probe position; a tie takes the earlier point."""
    c = F.col
    near = neighbours(points, probes, keys, place, width, value)
    earlier = c("next_at").isNull() | (c(place) - c("prev_at") <= c("next_at") - c(place))
    return near.select(*keys, place, F.coalesce(
        F.when(c("prev_at").isNotNull() & earlier, c("prev_value")).otherwise(c("next_value")), F.lit(default)).alias(value))


def nearest_distance(points: DataFrame, probes: DataFrame, keys: Sequence[str], place: str, width: float,
                     default: int = 999) -> DataFrame:
    c = F.col
    near = neighbours(points, probes, keys, place, width)
    return near.select(*keys, place, F.coalesce(F.least(c(place) - c("prev_at"), c("next_at") - c(place)),
                                                F.lit(default)).alias("distance"))


def proximity(steps: DataFrame, targets: DataFrame, keys: Sequence[str], place: str, beside: float) -> DataFrame:
    """1.0 on a target step, ``beside`` next to one, else 0, by an equality join."""
    around = F.array(*[F.struct((F.col(place) + d).alias("at"), F.lit(1.0 if d == 0 else beside).alias("w")) for d in (-1, 0, 1)])
    weights = (targets.select(*keys, place).distinct().select(*keys, F.explode(around).alias("a"))
                      .groupBy(*keys, F.col("a.at").alias(place)).agg(F.max("a.w").alias("proximity")))
    return steps.select(*keys, place).distinct().join(weights, [*keys, place], "left").fillna(0.0, ["proximity"])
