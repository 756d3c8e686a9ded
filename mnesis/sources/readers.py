"""Readers of session indexes, events, montages and configurations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mnesis.schemas import EVENTS, PAIR

_S = T.StringType()
SESSION = T.StructType([*(T.StructField(c, _S) for c in ("all_events", "task_events", "math_events", "contacts", "pairs", "import_type", "localization", "montage", "subject_alias")), T.StructField("system_version", T.DoubleType())])
INDEX = T.StructType([T.StructField("protocols", T.StructType([T.StructField("r1", T.StructType([
    T.StructField("subjects", T.MapType(_S, T.StructType([T.StructField("experiments", T.MapType(_S, T.StructType([T.StructField("sessions", T.MapType(_S, SESSION))])))]))),
]))]))])


def session_index(spark: SparkSession, path: str) -> DataFrame:
    """A row for each subject, experiment and session of nested index files."""
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", INDEX).alias("j"))
    subjects = text.select(F.explode("j.protocols.r1.subjects").alias("subject", "s"))
    experiments = subjects.select("subject", F.explode("s.experiments").alias("experiment", "e"))
    return experiments.select("subject", "experiment", F.explode("e.sessions").alias("session", "v")).select("subject", "experiment", F.col("session").cast("long").alias("session"), "v.*")


def subjects_of(index: DataFrame, experiment: str) -> DataFrame:
    return index.where(F.col("experiment") == experiment).select("subject").distinct()


def completed_sessions(index: DataFrame, subject: str, experiment: str) -> DataFrame:
    return index.where((F.col("subject") == subject) & (F.col("experiment") == experiment)).select("session").distinct()


#: Files that ``events`` lets the driver list; more are opened by tasks.
LISTED = 1000


def events(spark: SparkSession, index: DataFrame, file_type: str = "all_events", root: str = "", with_eeg: bool = True, schema: T.StructType = EVENTS, multiline: bool = True, with_file: bool = False, listed: int = LISTED) -> DataFrame:
    """Events of all sessions of an index that have a file, with subject, experiment and session of the index. No session gives
    an empty table. multiline: a file is one JSON array; else a row a line. with_file: also the path, which tells recordings
    apart whatever their rows say.

    Up to ``listed`` files are one scan, whose paths the driver holds. More are opened by tasks (see ``event_rows``) where
    pyarrow knows the file system; a file that can't be read is an error then, too, when the plan runs."""
    plain = lambda c: F.regexp_replace(c, "^(file:/+|/+)", "/")  # noqa: E731  file:///a, file:/a and /a are one path
    known = index.where(F.col(file_type).isNotNull()).select("subject", "experiment", "session", F.concat(F.lit(root), F.col(file_type)).alias("_path"))
    names = known.select("_path").distinct()
    paths = [r["_path"] for r in names.limit(listed + 1).collect()]
    if not paths:
        return spark.createDataFrame([], T.StructType([*schema, T.StructField("file", _S)]) if with_file else schema)
    columns = [f.name for f in schema]
    if len(paths) > listed and _opens(paths[0]):
        rows = event_rows(index, file_type, root, with_eeg, schema, multiline).where(F.assert_true(F.col("error").isNull(), F.concat_ws(": ", "file", "error")).isNull())
        return rows.select(*columns, *([plain("file").alias("file")] if with_file else []))
    paths = paths if len(paths) <= listed else [r["_path"] for r in names.collect()]
    rows = spark.read.schema(schema).json(paths, multiLine=multiline).withColumn("_file", F.col("_metadata.file_path"))
    rows = rows.drop("subject", "experiment", "session").withColumn("_file", plain("_file")).join(known.withColumn("_file", plain("_path")), "_file").select(*columns, *([F.col("_file").alias("file")] if with_file else []))
    return rows.where(F.col("eegfile") != "") if with_eeg else rows


def _opens(path: str) -> bool:
    """Whether pyarrow knows the file system of a path."""
    from pyarrow import ArrowInvalid, ArrowNotImplementedError, fs

    try:
        fs.FileSystem.from_uri(path)
    except (OSError, ArrowInvalid, ArrowNotImplementedError):
        return False
    return True


def file_texts(paths: DataFrame, path: str, per_task: int = 500) -> DataFrame:
    """paths with the text of the file that the column ``path`` names, or why it can't be read: (its columns, text, error).

    Files are opened where they are dealt to, by tasks of about ``per_task`` files, so neither the driver nor the planner has
    a list of them, and a missing file is a row, not an error. A row without a path has neither text nor error. Paths are of a
    file system that pyarrow knows (local, HDFS, S3, GCS); for another, ``events`` lets Spark read. A file is one row, so it
    must fit a task's memory, as a session's events do."""
    names = [*paths.columns, "text", "error"]

    def read(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            texts, errors, size, start = [], [], 0, 0
            at = batch.column(batch.schema.get_field_index(path)).to_pylist()
            for i, name in enumerate(at):
                got = why = None
                if name is not None:
                    try:
                        store, inner = fs.FileSystem.from_uri(name)
                        with store.open_input_stream(inner) as f:
                            got = f.read().decode("utf-8", "replace")
                    except (OSError, pa.ArrowInvalid) as e:
                        why = f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"
                texts.append(got)
                errors.append(why)
                size += len(got or "")
                if size > 16 << 20 or i + 1 == len(at):
                    yield pa.RecordBatch.from_arrays([*batch.slice(start, i + 1 - start).columns, pa.array(texts, pa.string()), pa.array(errors, pa.string())], names)
                    texts, errors, size, start = [], [], 0, i + 1

    shape = ", ".join(f"`{c}` {t}" for c, t in [*paths.dtypes, ("text", "string"), ("error", "string")])
    return paths.repartition(max(1, -(-paths.count() // per_task)), path).mapInArrow(read, shape)


def event_rows(index: DataFrame, file_type: str = "all_events", root: str = "", with_eeg: bool = True, schema: T.StructType = EVENTS, multiline: bool = True) -> DataFrame:
    """A row for each event of an index's files, and one for each file that can't be read: the schema's columns, file, error
    (null for events). Each file is opened once, by tasks, see ``file_texts``. Sessions without a file give nothing."""
    known = index.where(F.col(file_type).isNotNull()).select("subject", "experiment", "session", F.concat(F.lit(root), F.col(file_type)).alias("file"))
    own, broken = ("subject", "experiment", "session"), F.col("error").isNotNull()
    nothing = lambda kind: F.array(F.lit(None).cast(kind))  # noqa: E731  keeps an unread file's row
    lines = F.array("text") if multiline else F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    rows = file_texts(known, "file").select(*own, "file", "error", F.explode(F.when(broken, nothing("string")).otherwise(lines)).alias("text"))
    parsed = rows.select(*own, "file", "error", F.explode(F.when(broken, nothing(schema)).otherwise(F.from_json("text", T.ArrayType(schema)))).alias("e"))
    found = parsed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in own else F.col(f"e.{f.name}").alias(f.name) for f in schema], "file", "error")
    return found.where(F.col("error").isNotNull() | (F.col("eegfile") != "")) if with_eeg else found


def events_by_tasks(index: DataFrame, file_type: str = "all_events", root: str = "", with_eeg: bool = True, schema: T.StructType = EVENTS, multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """(events, unread files): as ``events``, but tasks read the files of an index of any length. Unread files are rows of the
    index with their path and the reason; sessions without a file aren't among them. Each of the two opens all files;
    ``event_rows`` has both in one pass."""
    rows = event_rows(index, file_type, root, with_eeg, schema, multiline)
    return rows.where("error IS NULL").drop("file", "error"), rows.where("error IS NOT NULL").select("subject", "experiment", "session", "file", "error")


def parameter_search_events(rows: DataFrame) -> DataFrame:
    return rows.where("list > -1")


def sample_rates(spark: SparkSession, path: str) -> DataFrame:
    """(path, sample_rate) of each sources file, from its first entry."""
    source = T.MapType(_S, T.StructType([T.StructField("sample_rate", T.DoubleType())]))
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", source).alias("m"))
    return text.select("path", F.element_at(F.map_values("m"), 1)["sample_rate"].alias("sample_rate"))


def pairs(spark: SparkSession, path: str) -> DataFrame:
    """subject, pair_idx, label and the pair's fields, in the order of the file; a version entry doesn't count."""
    one = T.MapType(_S, T.StructType([T.StructField("pairs", T.MapType(_S, PAIR))]))
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r'"version"\s*:\s*("[^"]*"|[0-9.]+)\s*,?', "").alias("value"))
    rows = text.select(F.explode(F.from_json("value", one)).alias("subject", "p")).select("subject", F.posexplode("p.pairs").alias("pair_idx", "label", "pair"))
    return rows.select("subject", "pair_idx", "label", "pair.*")


def one_montage(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """candidates, with an error when the plan runs for a session with more than one montage file."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return candidates.withColumn("_n", n).where(F.assert_true(F.col("_n") == 1, F.lit("more than one montage file")).isNull()).drop("_n")


def recorded_or_montage(recorded: DataFrame, montage: DataFrame, key: str) -> DataFrame:
    """The recorded pairs of each subject that has any, else its montage's."""
    return recorded.unionByName(montage.join(recorded.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, value): the lines of small text files with their numbers."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\r?\n")).alias("n", "value")).where("value <> ''")


def electrode_config(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of an electrode configuration: its sense channels with the labels of their contact and reference."""
    lines = numbered_lines(spark, path)
    heading = F.when(F.col("value").rlike(r"^[A-Za-z]+:"), F.regexp_extract("value", r"^([A-Za-z]+):", 1))
    rows = lines.withColumn("section", F.last(heading, ignorenulls=True).over(Window.partitionBy("path").orderBy("n"))).where(~F.col("value").rlike(r"^[A-Za-z]+:"))
    cell = F.split("value", ",")
    contacts = rows.where("section = 'Contacts'").select("path", cell[0].alias("name"), F.trim(cell[1]).cast("int").alias("jack"))
    sense = rows.where("section = 'SenseChannels'").select("path", "n", cell[0].alias("label"), F.trim(cell[2]).try_cast("int").alias("channel_1"), F.trim(cell[3]).try_cast("int").alias("channel_2"))
    side = lambda k, name: contacts.select("path", F.col("jack").alias(k), F.col("name").alias(name))
    got = sense.join(side("channel_1", "anode"), ["path", "channel_1"], "left").join(side("channel_2", "cathode"), ["path", "channel_2"], "left")
    return got.select("path", F.row_number().over(Window.partitionBy("path").orderBy("n")).alias("pair_idx"), "channel_1", "channel_2", F.concat_ws("-", "anode", "cathode").alias("label"))


def jacksheet(spark: SparkSession, path: str) -> DataFrame:
    part = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where("trim(value) <> ''").select(part[0].cast("int").alias("number"), part[1].alias("label"))


def leads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where("trim(value) <> ''").select(F.trim("value").alias("lead"))


def bad_channels(spark: SparkSession, path: str) -> DataFrame:
    """Labels after the heading of bad electrodes or broken leads, up to the next heading."""
    lines = numbered_lines(spark, path)
    low = F.lower(F.trim("value"))
    heading = F.when(low.rlike("bad electrodes|broken leads"), True).when(low.rlike(r"\s|:"), False)
    rows = lines.withColumn("_in", F.last(heading, ignorenulls=True).over(Window.partitionBy("path").orderBy("n")))
    return rows.where(F.col("_in") & heading.isNull()).select(F.upper(F.trim("value")).alias("label"))


def artifact_detection(rows: DataFrame) -> DataFrame:
    """Start and end offsets of the artifact detection of each session, from rows whose type starts so."""
    found = rows.where(F.col("type").startswith("ARTIFACT_DETECTION"))
    return found.groupBy("subject", "experiment", "session").agg(F.map_from_entries(F.collect_set(F.struct("type", "mstime"))).alias("info"))


def stim_events(rows: DataFrame, checks=None) -> DataFrame:
    """Stimulations with a recording; an error where there is none: when the block of ``checks`` (operators.checks) ends, or,
    without checks, at once, which looks for a row first."""
    found = rows.where((F.col("type") == "STIM_ON") & (F.coalesce("eegfile", F.lit("")) != ""))
    if checks is not None:
        return checks.some(found, "no stimulation with a recording")
    if found.isEmpty():
        raise ValueError("no stimulation with a recording")
    return found


def connectivity(spark: SparkSession, path: str) -> DataFrame | None:
    """Edges (roi_i, roi_j, w) of a structural connectivity table, None where there isn't exactly one file."""
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").limit(2).count()
    return spark.read.parquet(path).select("roi_i", "roi_j", "w") if there == 1 else None
