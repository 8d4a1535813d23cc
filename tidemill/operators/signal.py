"""Sample series to windows, features, events and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ordered import MAX_ROWS_PER_TASK, OrderedRuns
from tidemill.schema import FEATURES, LABEL_PREFIXES, SAMPLING_RATE_HZ, WINDOW_SAMPLES


def _window_index(size: int) -> Column:
    return F.floor(F.col("sample_idx") / size).cast("int").alias("window_idx")


def segment_windows(
    samples: DataFrame, size: int = WINDOW_SAMPLES, key: str = "source_file"
) -> DataFrame:
    """(recording, window_idx, waveform) of the complete windows of a long sample table.

    A window is bounded by ``size``, so collecting it into one array is safe.
    """
    return (
        samples.groupBy(key, _window_index(size))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.array_sort(F.collect_list(F.struct("sample_idx", "value"))).alias("_w"),
        )
        .filter(F.col("_n") == size)
        .select(key, "window_idx", F.col("_w.value").alias("waveform"))
    )


def segment_arrays(
    recordings: DataFrame,
    size: int = WINDOW_SAMPLES,
    key: str = "source_file",
    signal: str = "signal",
) -> DataFrame:
    """The same for recordings held as one array per row; needs no shuffle."""
    n = F.floor(F.size(signal) / size).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1))
    return recordings.select(key, signal, F.explode(starts).alias("window_idx")).select(
        key,
        "window_idx",
        F.slice(signal, F.col("window_idx") * size + 1, F.lit(size)).alias("waveform"),
    )


def time_domain_features(
    samples: DataFrame, size: int = WINDOW_SAMPLES, key: str = "source_file"
) -> DataFrame:
    """Features of every complete window, straight from the long sample table.

    One aggregation with map-side partials: no window is ever gathered. Variance, skew and
    kurtosis are the population moments, kurtosis as excess; both are NULL for a constant
    window, which the validity check then quarantines.
    """
    x = F.col("value")
    out = (
        samples.groupBy(key, _window_index(size))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sqrt(F.avg(x * x)).alias("rms"),
            F.max(F.abs(x)).alias("peak"),
            F.kurtosis(x).alias("kurtosis"),
            F.skewness(x).alias("skew"),
            F.var_pop(x).alias("variance"),
            F.avg(F.abs(x)).alias("mean_abs"),
        )
        .filter(F.col("_n") == size)
    )
    return out.withColumn("crest", _crest()).select(key, "window_idx", *FEATURES)


def _crest() -> Column:
    return F.when(F.col("rms") > 0, F.col("peak") / F.col("rms")).when(F.col("rms").isNotNull(), F.lit(0.0))


def waveform_features(df: DataFrame, waveform: str = "waveform") -> DataFrame:
    """The same features for windows held as arrays: row-local, no shuffle."""
    n = F.size(waveform)
    values = F.transform(waveform, lambda v: v.cast("double"))

    def mean_of(of) -> Column:
        # an empty window has no features, and the validity check quarantines it
        return F.try_divide(F.aggregate("_v", F.lit(0.0), lambda acc, v: acc + of(v)), F.col("_n"))

    based = df.withColumn("_v", values).withColumn("_n", n).withColumn("_mean", mean_of(lambda v: v))

    def central(power: int) -> Column:
        def term(v: Column) -> Column:
            d = v - F.col("_mean")
            out = d
            for _ in range(power - 1):
                out = out * d
            return out

        return mean_of(term)

    m2, m3, m4 = F.col("variance"), F.col("_m3"), F.col("_m4")
    return (
        based.withColumn("rms", F.sqrt(mean_of(lambda v: v * v)))
        .withColumn("peak", F.array_max(F.transform("_v", F.abs)))
        .withColumn("mean_abs", mean_of(F.abs))
        .withColumn("variance", central(2))
        .withColumn("_m3", central(3))
        .withColumn("_m4", central(4))
        .withColumn("skew", F.when(m2 > 0, m3 / F.pow(m2, F.lit(1.5))))
        .withColumn("kurtosis", F.when(m2 > 0, m4 / (m2 * m2) - 3.0))
        .withColumn("crest", _crest())
        .select(*df.columns, *FEATURES)
    )


def label_from_prefix(
    file: Column, prefixes: Sequence[str] = LABEL_PREFIXES
) -> Column:
    """The class a file name starts with; NULL (for the quarantine) if it has none."""
    return F.coalesce(*[F.when(file.startswith(p), p) for p in prefixes])


def pick_channel(variables: DataFrame, suffix: str = "_DE_time") -> tuple[DataFrame, DataFrame]:
    """(chosen channel per file, files with none).

    ``variables`` lists (source_file, variable). A file may carry stray channels of another
    recording: the one with the highest number is its own.
    """
    number = F.regexp_extract("variable", r"(\d+)", 1).try_cast("long")
    is_channel = F.col("variable").endswith(suffix)
    chosen = variables.groupBy("source_file").agg(
        F.max(F.when(is_channel, F.struct(number.alias("number"), "variable"))).alias("_best"),
        F.count_if(is_channel).alias("n_candidates"),
    )
    return (
        chosen.filter("n_candidates > 0").select(
            "source_file", F.col("_best.variable").alias("variable"), "n_candidates"
        ),
        chosen.filter("n_candidates = 0").select("source_file"),
    )


def keep_channel(samples: DataFrame, chosen: DataFrame) -> DataFrame:
    """Samples of the chosen channels only."""
    return samples.join(chosen.select("source_file", "variable"), ["source_file", "variable"],
                        "left_semi")


def windows_to_records(
    features: DataFrame,
    run_id: str,
    device_id: str,
    base_ts: str,
    sampling_rate_hz: int = SAMPLING_RATE_HZ,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Raw sensor records, ready for ``translate_sensor``: one per window, no waveform.

    ``seq`` numbers all windows from 1 in (file, window) order; each record is stamped
    ``base_ts`` plus ``seq`` seconds.
    """
    if not run_id:
        raise ValueError("run_id is mandatory")
    numbered = (
        OrderedRuns.of(features, [], ["source_file", "window_idx"], max_rows)
        .running(seq=("sum", F.lit(1).cast("long")))
        .rows()
    )
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(base_ts).cast("timestamp")) + F.col("seq"))
    record = F.struct(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ts"),
        "seq",
        F.lit(device_id).alias("sensor_id"),
        F.col("source_file").alias("file"),
        F.col("ground_truth_label").alias("label"),
        "window_idx",
        F.struct(*FEATURES).alias("features"),
        F.lit(sampling_rate_hz).alias("sampling_rate_hz"),
        F.lit(run_id).alias("dataset_run_id"),
    )
    return numbered.select(
        F.to_json(record).alias("raw_body"), F.to_variant_object(record).alias("raw")
    )


def recording_summary(samples_per_file: DataFrame, size: int = WINDOW_SAMPLES) -> DataFrame:
    """Per-file rows plus totals by (label, split), by label and overall.

    Input: (source_file, ground_truth_label, dataset_split, n_samples). ``level`` tells the
    rows apart: file, label_split, label, total.
    """
    counted = samples_per_file.withColumn(
        "n_windows", F.floor(F.col("n_samples") / size).cast("long")
    )
    totals = [F.sum("n_windows").alias("n_windows"), F.sum("n_samples").alias("n_samples")]
    rolled = (
        counted.rollup("ground_truth_label", "dataset_split", "source_file")
        .agg(*totals, F.grouping_id().alias("_g"))
        .withColumn(
            "level",
            F.when(F.col("_g") == 0, "file")
            .when(F.col("_g") == 1, "label_split")
            .when(F.col("_g") == 3, "label")
            .otherwise("total"),
        )
    )
    return rolled.select(
        "level", "source_file", "ground_truth_label", "dataset_split", "n_windows", "n_samples"
    )
