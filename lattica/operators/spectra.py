"""Peak tables: spectral features, mass matching, recalibration, histograms, consensus axis, rebinning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lattica.functions.tables import dealt, written
from lattica.operators.range_joins import beside_cells, ppm_join

MODE = ["sample_id", "ion_mode"]
SPECTRUM = [*MODE, "spot_id"]


def sound_spectra(spectra: DataFrame) -> DataFrame:
    """Drop spectra (``mz``, ``intensity`` arrays) that hold a NaN or an infinity, or whose arrays differ in length."""
    bad = lambda c: F.exists(c, lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
    return spectra.filter(~bad("mz") & ~bad("intensity") & (F.size("mz") == F.size("intensity")))


def truncated(locators: DataFrame, file_bytes: int, item_bytes: int) -> DataFrame:
    """Locators (``n``, ``offset``) that reach beyond the end of their binary file."""
    return locators.filter(F.col("offset") + F.col("n") * item_bytes > file_bytes)


def exploded(spectra: DataFrame) -> DataFrame:
    """Peaks of positive mass, numbered in their spectrum."""
    rows = spectra.select(*SPECTRUM, F.posexplode(F.arrays_zip("mz", "intensity")).alias("peak_id", "p"))
    return rows.select(*SPECTRUM, F.col("peak_id").cast("long").alias("peak_id"), "p.mz", "p.intensity").filter("mz > 0")


def spectrum_features(peaks: DataFrame) -> DataFrame:
    """Per spectrum: peaks, total intensity, Shannon entropy in bits (0 below two peaks), log1p of the total."""
    p = F.col("intensity") / F.sum("intensity").over(Window.partitionBy(*SPECTRUM))
    rows = dealt(peaks.select(*SPECTRUM, "intensity"), *SPECTRUM).withColumn("p", p).withColumn("h", F.when(F.col("p") > 0, -F.col("p") * F.log2("p")).otherwise(0.0))
    out = rows.groupBy(*SPECTRUM).agg(F.count("*").alias("n_peaks"), F.sum("intensity").alias("tic"), F.sum("h").alias("h"))
    return out.select(*SPECTRUM, "n_peaks", "tic", F.when(F.col("n_peaks") < 2, 0.0).otherwise(F.col("h")).alias("entropy"), F.log1p("tic").alias("log_tic"))


def composite_score(features: DataFrame, columns: list[str], by: list[str] = MODE) -> DataFrame:
    """Mean of the columns scaled to [0, 1] within each group; a column that doesn't vary counts as 0.  The features are written once, as they are read twice."""
    features = written(features, "features")
    ends = features.groupBy(*by).agg(*[f(c).alias(f"__{k}_{c}") for c in columns for f, k in ((F.min, "lo"), (F.max, "hi"))])
    scaled = []
    for c in columns:
        low, high = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        scaled.append(F.when(high - low <= 1e-12, 0.0).otherwise((F.col(c) - low) / F.nullif(high - low, F.lit(0.0))))
    out = features.join(F.broadcast(ends), by).withColumn("score", sum(scaled[1:], scaled[0]) / len(columns))
    return out.select(*features.columns, "score")


def otsu(df: DataFrame, value: str, by: list[str], bins: int = 256) -> DataFrame:
    """Threshold of greatest between-class variance: (``by``, threshold = lower edge of the last low bin, so that bin stays above it).

    Values are scaled to 0 .. ``bins`` - 1 and cut to whole numbers; the first bin wins ties; a group
    without spread gets its value.
    """
    ends = df.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    b = F.coalesce(F.floor((F.col(value) - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * (bins - 1)), F.lit(0))
    h = df.join(F.broadcast(ends), by).groupBy(*by, "lo", "hi", b.cast("long").alias("bin")).agg(F.count("*").alias("n"))
    best = split_level(h, by + ["lo", "hi"])
    return best.select(*by, (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / (bins - 1)).alias("threshold"))


def split_level(histogram: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, bin): the last low level of the histogram (``by``, bin, n) with the greatest variance between levels up to it and above; the first on ties, the only one without others.  Whole-number sums, so ties are exact."""
    run, all_ = Window.partitionBy(*by).orderBy("bin"), Window.partitionBy(*by)
    part = F.col("n") * F.col("bin")
    h = histogram.withColumns({"w0": F.sum("n").over(run), "s0": F.sum(part).over(run), "w": F.sum("n").over(all_), "s": F.sum(part).over(all_)})
    gap = (F.col("s0") * F.col("w") - F.col("s") * F.col("w0")).cast("double")
    v = gap * gap / F.nullif((F.col("w0") * (F.col("w") - F.col("w0"))).cast("double"), F.lit(0.0))
    return h.withColumn("v", F.coalesce(v, F.lit(-1.0))).groupBy(*by).agg(F.max_by("bin", F.struct("v", -F.col("bin"))).alias("bin"))


def floored_threshold(df: DataFrame, value: str, by: list[str], bins: int = 256) -> DataFrame:
    """Otsu's threshold, but at most the 25th percentile, so that a quarter at most is lost: (``by``, threshold)."""
    low = quantile(df, value, by, 0.25).withColumnRenamed("q", "__q")
    return otsu(df, value, by, bins).join(low, by).select(*by, F.least("threshold", "__q").alias("threshold"))


#: Levels into which a round of ``quantile`` cuts a range, and values of a group that one task sorts.
LEVELS, FEW = 4096, 10_000


def quantile(df: DataFrame, value: str, by: list[str], share: float) -> DataFrame:
    """(``by``, q): the exact quantile of each group, linear between neighbours; nulls are left out, groups without a value have no row.

    Rounds count values at LEVELS levels between the ends of what is left and keep the level that holds
    the lower neighbour, until no group keeps more than FEW values or they are all equal; only these are
    sorted.  A round leaves counts in the exchange, never values, so a large group is no task's.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("__v")).filter("__v is not null")
    ends = rows.groupBy(*by).agg(F.min("__v").alias("lo"), F.max("__v").alias("hi"), F.count("*").alias("n"))
    # left: values between the ends; k: rank of the lower neighbour among them
    left = written(ends.withColumns({"at": (F.col("n") - 1) * share, "left": F.col("n")}).withColumn("k", F.floor("at")), "quantile")
    inside = (F.col("__v") >= F.col("lo")) & (F.col("__v") <= F.col("hi"))
    part = (F.col("__v") / 2 - F.col("lo") / 2) / F.nullif(F.col("hi") / 2 - F.col("lo") / 2, F.lit(0.0))
    level = F.when(F.col("__v") <= F.col("lo"), 0).when(F.col("__v") >= F.col("hi"), LEVELS + 1).otherwise(1 + F.least(F.lit(LEVELS - 1), F.floor(F.nanvl(part, F.lit(0.5)) * LEVELS)))
    large = f"left > {FEW} and lo <> hi"
    while not left.filter(large).isEmpty():
        met = rows.join(F.broadcast(left.filter(large)), by).filter(inside)  # a row a group
        counts = met.groupBy(*by, level.alias("__level")).agg(F.min("__v").alias("lo"), F.max("__v").alias("hi"), F.count("*").alias("left"))
        run = F.sum("left").over(Window.partitionBy(*by).orderBy("__level"))
        kept = counts.withColumn("__to", run).join(left.select(*by, "n", "at", "k"), by).filter((F.col("k") >= F.col("__to") - F.col("left")) & (F.col("k") < F.col("__to")))
        kept = kept.withColumn("k", F.col("k") - F.col("__to") + F.col("left")).select(*left.columns)
        left = written(left.filter(f"not ({large})").unionByName(kept), "quantile")
    few = rows.join(F.broadcast(left.filter("lo <> hi")), by).filter(inside)
    lower = few.groupBy(*by, "k").agg(F.sort_array(F.collect_list("__v")).alias("v")).select(*by, F.get("v", F.col("k").cast("int")).alias("__low"))
    lower = left.join(lower, by, "left").select(*by, "at", F.coalesce("__low", "lo").alias("__low"))
    met = rows.join(F.broadcast(lower), by)
    both = met.groupBy(*by, "at", "__low").agg(F.count_if(F.col("__v") <= F.col("__low")).alias("__upto"), F.min(F.when(F.col("__v") > F.col("__low"), F.col("__v"))).alias("__next"))
    rest = F.col("at") - F.floor("at")
    high = F.when(F.col("__upto") > F.floor("at") + 1, F.col("__low")).otherwise(F.col("__next"))
    return both.select(*by, F.when((rest == 0) | (high == F.col("__low")), F.col("__low")).otherwise((1 - rest) * F.col("__low") + rest * high).alias("q"))


def annotate(masses: DataFrame, database: DataFrame, ppm: float) -> DataFrame:
    """Names of database masses within [m - tol, m + tol], tol of the axis mass, same ion mode, in database order joined by '; '."""
    tol = F.col("mz") * ppm * 1e-6
    hit = ppm_join(masses, database.select("ion_mode", "ord", "db_name", "ionized_mass"), ["ion_mode"], "mz", "ionized_mass", ppm, (F.col("ionized_mass") >= F.col("mz") - tol) & (F.col("ionized_mass") <= F.col("mz") + tol))
    named = hit.groupBy("ion_mode", "mz").agg(F.sort_array(F.collect_list(F.struct("ord", "db_name"))).alias("a"))
    named = named.select("ion_mode", "mz", F.array_join(F.transform("a", lambda s: s.db_name), "; ").alias("annotation"))
    return masses.join(named, ["ion_mode", "mz"], "left").withColumn("annotation", F.coalesce("annotation", F.lit("Unannotated")))


def rebin(peaks: DataFrame, axis: DataFrame, ppm: float) -> DataFrame:
    """Spread peaks over axis masses in [m(1 - t), m(1 + t)) by inverse ppm distance; a matched peak's intensity is conserved, an unmatched one lost."""
    t = ppm * 1e-6
    met = beside_cells(peaks, axis.select("ion_mode", F.col("mz").alias("ref")), ["ion_mode"], "mz", "ref", ppm)
    inside = F.filter("near", lambda r: (r >= F.col("mz") * (1 - t)) & (r < F.col("mz") * (1 + t)))
    weight = lambda r: 1 / (F.abs(r - F.col("mz")) / F.col("mz") * 1e6 + 1e-9)
    shared = met.select(*SPECTRUM, "intensity", F.transform(inside, lambda r: F.struct(r.alias("ref"), weight(r).alias("w"))).alias("m"))
    all_ = F.aggregate("m", F.lit(0.0), lambda s, x: s + x.w)
    each = shared.select(*SPECTRUM, "intensity", all_.alias("all"), F.explode("m").alias("m"))
    return each.groupBy(*SPECTRUM, F.col("m.ref").alias("ref")).agg(F.sum(F.col("intensity") * (F.col("m.w") / F.col("all"))).alias("value"))


def match_calibrants(peaks: DataFrame, references: DataFrame, ppm: float, min_intensity: float) -> DataFrame:
    """Per spectrum and reference the most intense peak within ppm of the reference (first peak on ties) and its offset."""
    met = beside_cells(peaks.filter(F.col("intensity") >= min_intensity), references, ["ion_mode"], "mz", "ref", ppm)
    hit = F.explode(F.filter("near", lambda r: F.abs(F.col("mz") - r) <= r * ppm * 1e-6)).alias("ref")
    pairs = met.select(*SPECTRUM, "peak_id", "mz", "intensity", hit)
    return pairs.groupBy(*SPECTRUM, "ref").agg(F.max_by("mz", F.struct("intensity", -F.col("peak_id"))).alias("mz")).withColumn("offset", F.col("mz") - F.col("ref"))


def row_offsets(matches: DataFrame, rows: DataFrame) -> DataFrame:
    """Mean offset a scan row (``rows``: spot_id, row); rows without a match have no entry."""
    return matches.join(rows, "spot_id").groupBy(*MODE, "row").agg(F.avg("offset").alias("offset"))


def recalibrated(peaks: DataFrame, rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """Peaks less their scan row's offset; unchanged where there is none."""
    out = peaks.join(rows, "spot_id").join(offsets, [*MODE, "row"], "left")
    return out.withColumn("mz", F.col("mz") - F.coalesce("offset", F.lit(0.0))).drop("offset")


def nearest_hits(peaks: DataFrame, database: DataFrame, ppm: float) -> DataFrame:
    """Share of a spectrum's number of peaks made up by the distinct database rows that its peaks choose.

    An as-of match on both sides: the greatest mass below the peak if the peak is within tolerance (of
    the mass), else the least mass not below it; neither, no choice.  Of database rows of one mass the
    first is chosen from below and the last from above, so they count twice if both happen.
    """
    masses = written(database.groupBy("ion_mode", "ionized_mass").agg((F.count("*") > 1).alias("twice")), "masses")
    met = beside_cells(dealt(peaks.select(*SPECTRUM, "mz"), *SPECTRUM), masses, ["ion_mode"], "mz", "ionized_mass", ppm, "left")
    within = lambda m: F.abs(F.col("mz") - m) <= m * ppm * 1e-6
    left, right = F.array_max(F.filter("near", lambda m: m < F.col("mz"))), F.array_min(F.filter("near", lambda m: m >= F.col("mz")))
    side = met.withColumns({"left": left, "right": right})
    from_left = F.coalesce(within(F.col("left")), F.lit(False))
    chosen = side.withColumn("hit", F.when(from_left, F.col("left")).when(within(F.col("right")), F.col("right"))).withColumn("above", from_left)
    doubled = masses.filter("twice").select("ion_mode", F.col("ionized_mass").alias("hit"), "twice")
    marked = chosen.join(doubled, ["ion_mode", "hit"], "left").withColumn("above", F.coalesce("twice", F.lit(False)) & F.col("above"))
    kinds = marked.groupBy(*SPECTRUM, "hit", "above").agg(F.count("*").alias("n"))
    out = kinds.groupBy(*SPECTRUM).agg(F.sum("n").alias("n_peaks"), F.count("hit").alias("hits"))
    return out.select(*SPECTRUM, "n_peaks", "hits", (F.col("hits") / F.col("n_peaks")).alias("share"))


def log_histogram(peaks: DataFrame, ppm: float) -> DataFrame:
    """Counts and mass sums in logarithmic bins of half the tolerance, per sample (merge samples by summing again)."""
    return peaks.filter("mz > 0").withColumn("bin", F.floor(F.log("mz") / (ppm * 1e-6 / 2))).groupBy(*MODE, "bin").agg(F.count("*").alias("n"), F.sum("mz").alias("mass"))


def merged_histogram(histogram: DataFrame) -> DataFrame:
    """Histograms of all samples in one, with the number of samples in each bin."""
    return histogram.groupBy("ion_mode", "bin").agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"), F.count_distinct("sample_id").alias("samples"))


def _fold(mz: list[float], weight: list[float], s: float, w: float, n: int, ppm: float) -> tuple[list[tuple], tuple]:
    """Clusters closed by a run of sorted masses that starts with an open cluster (sum, weight, members), and the one it leaves open."""
    closed = []
    for m, k in zip(mz, weight, strict=True):
        if n and abs(m - s / w) / (s / w) * 1e6 <= ppm:
            s, w, n = s + m * k, w + k, n + 1
        else:
            if n:
                closed.append((s, w, n))
            s, w, n = m * k, k, 1
    return closed, (s, w, n)


def ppm_clusters(masses: DataFrame, ppm: float, by: list[str], width: float = 0.01) -> DataFrame:
    """Sequential clustering of (``by``, mz, weight): a mass joins while within ppm of the running weighted centre.

    Masses are dealt to logarithmic ranges of ``width``; each range is folded in one linear pass, with
    the open cluster of the range before.  That cluster isn't known at first, but a fold forgets where
    it started at the first break it shares with the true one, so ranges start empty and are folded
    again until no range's open cluster changes.  Two rounds are usual; where breaks don't meet (evenly
    spaced masses) ranges are made eight times as wide each further round, so rounds stay few.
    The result is exactly that of one pass over all masses.  Masses of zero or less are left out.
    Returns (``by``, mz, weight, members).
    """
    rows = written(masses.filter("mz > 0").select(*by, "mz", F.col("weight").cast("double").alias("weight")), "ppm-masses")
    while True:
        folded, ends, settled = _folded_ranges(rows, ppm, by, width)
        if settled:
            break
        width *= 8
    last = ends.withColumn("__last", F.lead("__range").over(Window.partitionBy(*by).orderBy("__range")).isNull()).filter("__last").drop("__last")
    every = folded.filter("not open").unionByName(last)
    return every.select(*by, (F.col("s") / F.col("w")).alias("mz"), F.col("w").alias("weight"), F.col("n").alias("members"))


def _folded_ranges(rows: DataFrame, ppm: float, by: list[str], width: float) -> tuple[DataFrame, DataFrame, bool]:
    """Closed and open clusters of every range after up to three folds, the open ones alone, and whether the last fold changed none of these."""
    import pyarrow as pa

    keys = [*by, "__range"]
    rows = rows.withColumn("__range", F.floor(F.log("mz") / width))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema]
    out_type = ", ".join([*fields, "open boolean", "s double", "w double", "n bigint"])

    def run(left, right):
        kinds = pa.schema([*[left.schema.field(k) for k in keys], ("open", pa.bool_()), ("s", pa.float64()), ("w", pa.float64()), ("n", pa.int64())])
        if not left.num_rows:
            return kinds.empty_table()
        left = left.sort_by([("mz", "ascending"), ("weight", "ascending")])
        start = right.to_pylist()[0] if right.num_rows else {"s": 0.0, "w": 0.0, "n": 0}
        closed, last = _fold(left.column("mz").to_pylist(), left.column("weight").to_pylist(), start["s"], start["w"], start["n"], ppm)
        s, w, n = zip(*closed, last, strict=True)
        head = [[left.column(k)[0].as_py()] * len(s) for k in keys]
        return pa.Table.from_pydict(dict(zip(kinds.names, [*head, [False] * len(closed) + [True], s, w, n], strict=True)), schema=kinds)

    carried = rows.select(*keys, *[F.lit(0).cast(t).alias(c) for c, t in (("s", "double"), ("w", "double"), ("n", "bigint"))]).limit(0)
    before = None
    for _ in range(3):
        folded = written(rows.groupBy(*keys).cogroup(carried.groupBy(*keys)).applyInArrow(run, out_type), "ppm-folded")
        ends = folded.filter("open")  # a row a range
        if before is None:
            settled = ends.groupBy(*by).count().filter("count > 1").isEmpty()  # one range each: nothing to carry
        else:
            was = before.select(*keys, F.struct("s", "w", "n").alias("was"))
            settled = ends.join(was, keys).filter(F.struct("s", "w", "n") != F.col("was")).isEmpty()
        if settled:
            return folded, ends, True
        before = ends
        carried = ends.select(*keys, *[F.lag(c).over(Window.partitionBy(*by).orderBy("__range")).alias(c) for c in "swn"]).filter("n is not null")
    return folded, ends, False


def backbone(peaks: DataFrame, ppm: float, threshold: float) -> DataFrame:
    """Consensus axis: masses rounded to six places, clustered per sample, clusters of at least threshold * the heaviest kept, and clustered again over samples."""
    counted = peaks.withColumn("mz", F.round("mz", 6)).groupBy(*MODE, "mz").agg(F.count("*").cast("double").alias("weight"))
    own = ppm_clusters(counted, ppm, MODE)
    top = own.groupBy(*MODE).agg(F.max("weight").alias("__top"))
    own = own.join(top, MODE).filter(F.col("weight") >= threshold * F.col("__top"))
    both = own.withColumn("mz", F.round("mz", 9)).groupBy("ion_mode", "mz").agg(F.sum("weight").alias("weight"))
    return ppm_clusters(both, ppm, ["ion_mode"])


def calibrants(histogram: DataFrame, n_samples: int, ppm: float) -> DataFrame:
    """Candidate reference masses: clusters of merged bins scored by occurrences times the share of samples."""
    merged = merged_histogram(histogram).select("ion_mode", (F.col("mass") / F.col("n")).alias("mz"), F.col("n").cast("double").alias("weight"))
    groups = ppm_clusters(merged, ppm, ["ion_mode"]).select("ion_mode", F.col("mz").alias("ref"), "weight")
    mean = histogram.select(*MODE, (F.col("mass") / F.col("n")).alias("mz"))
    seen = ppm_join(mean, groups, ["ion_mode"], "mz", "ref", 2 * ppm, F.abs(F.col("mz") - F.col("ref")) <= F.col("ref") * ppm * 1e-6)
    cover = seen.groupBy("ion_mode", "ref", "weight").agg(F.count_distinct("sample_id").alias("k"), F.array_sort(F.collect_set("sample_id")).alias("covers"))
    return cover.select("ion_mode", "ref", (F.col("weight") * F.col("k") / n_samples).alias("score"), "covers")


def greedy_cover(candidates: list[dict], samples: set[str], least: int = 5) -> list[dict]:
    """Best-scored first (lower mass on ties) until ``least`` are taken and all samples covered; then what covers the rest."""
    order = sorted(candidates, key=lambda r: (-r["score"], r["ref"]))
    taken, left = [], set(samples)
    for r in order:
        if len(taken) >= least and not left:
            break
        if len(taken) < least or left & set(r["covers"]):
            taken.append(r)
            left -= set(r["covers"])
    return taken
