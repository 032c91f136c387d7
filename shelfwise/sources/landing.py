"""Landing zone: daily batch folders of JSON catalogue files.

Layout ``<base>/batch_id=YYYY-MM-DD/<section>.json``, one JSON array per file.
The reader is one distributed scan:

* Hive-style partition discovery supplies ``batch_id`` (kept as a string);
* only ``*.json`` files are read (``pathGlobFilter``);
* the section is taken from each row's source file name (``_metadata``), or
  from a ``seccion=`` partition folder when the files were written by Spark;
* raw keys are renamed to their normal form on the *schema* — driver-side
  metadata only, rows are never shipped to the driver.  Keys that differ only
  by case are told apart in a side session with ``spark.sql.caseSensitive=true``,
  which reads the records one by one as always and writes them with names of
  their own; keys that normalise to the same name are coalesced (the
  alphabetically later raw key wins where both are set), and
  ``colliding_counts`` tells how many rows set several of them.

A multi-line JSON file is not splittable: read parallelism is the number of
files.  For large landings prefer many files, or JSON lines (``multiline=False``).

A file or record that does not parse is never dropped in silence: reading fails,
or, with ``on_error="divert"``, the rows that parse are returned and
``landing_rejects`` lists the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from shelfwise.functions.text import normalize_key
from shelfwise.session import delete_path, materialize, move_path, scratch_path, subfolders, subpaths


class LandingError(RuntimeError):
    pass


def normalized_names(columns: list[str], overrides: dict[str, str] | None = None
                     ) -> dict[str, list[str]]:
    """Normal name → raw names that map to it (in schema order)."""
    out: dict[str, list[str]] = {}
    for c in columns:
        out.setdefault(normalize_key(c, overrides), []).append(c)
    return out


def _partition_columns(spark: SparkSession, paths: list[str], base: str, glob: str) -> list[str]:
    """Columns that come from folder names (``batch_id=``, ...), from the listing."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("basePath", base).load(paths))
    return [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]


def _case_sensitive(spark: SparkSession) -> SparkSession:
    """A side session in which names that differ by case are different names."""
    side = spark.newSession()
    side.conf.set("spark.sql.caseSensitive", "true")
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionColumnTypeInference.enabled"):
        side.conf.set(k, spark.conf.get(k))
    return side


def infer_landing_schema(spark: SparkSession, path: str | list[str], *, base: str | None = None,
                         glob: str = "*.json", multiline: bool = True) -> T.StructType:
    """Schema of the landing records, inferred with case-sensitive names (one
    pass over the files).  Columns from folder names are left out; the session's
    own settings are not touched."""
    paths = [path] if isinstance(path, str) else list(path)
    sch = (_case_sensitive(spark).read.option("multiLine", str(multiline).lower())
           .option("pathGlobFilter", glob).option("basePath", base or paths[0])
           .json(paths).schema)
    folders = set(_partition_columns(spark, paths, base or paths[0], glob))
    return T.StructType([f for f in sch.fields if f.name not in folders])


def widen(inferred: T.DataType, hint: T.DataType) -> T.DataType:
    """Replace types that JSON inference degrades by the richer known type.

    An array that is empty in every record is inferred as ``array<string>`` and
    a field that is always NULL as ``string``; with a hint (the existing bronze
    type of the same column) the batch is parsed with that type instead, so
    its partition stays compatible with the others.  Struct fields are matched
    by name (case-insensitively, as nested fields are resolved); real type
    conflicts are left as inferred.
    """
    if isinstance(inferred, T.StructType) and isinstance(hint, T.StructType):
        hf = {f.name.lower(): f.dataType for f in hint.fields}
        return T.StructType([T.StructField(f.name, widen(f.dataType, hf[f.name.lower()])
                                           if f.name.lower() in hf else f.dataType, True)
                             for f in inferred.fields])
    if isinstance(inferred, T.ArrayType) and isinstance(hint, T.ArrayType):
        if isinstance(inferred.elementType, T.StringType | T.NullType) and \
                not isinstance(hint.elementType, T.StringType):
            return hint
        return T.ArrayType(widen(inferred.elementType, hint.elementType), True)
    if isinstance(inferred, T.NullType):
        return hint
    if isinstance(inferred, T.StringType) and isinstance(hint, T.StructType | T.ArrayType):
        return hint
    return inferred


CORRUPT = "_corrupt_record"
#: ``<section>.json``, or ``<section>~<number>.json`` if it takes several files.
SECTION_FILE = r"([^/]+?)(?:~\d+)?\.json$"


def _section_of(path: str, pattern: str) -> Column:
    """The section in the name of a file; paths come with URL escapes."""
    name = F.regexp_extract(path, pattern, 1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _typed(fields: list[T.StructField], hints: T.StructType | None,
           overrides: dict[str, str] | None) -> list[T.StructField]:
    """``fields`` with the types of the hints, which go by normalised name."""
    known = {} if hints is None else {f.name: f.dataType for f in hints.fields}
    out = []
    for f in fields:
        hint = known.get(normalize_key(f.name, overrides))
        out.append(T.StructField(f.name, widen(f.dataType, hint) if hint is not None else f.dataType, True))
    return out


def _records(spark: SparkSession, path, base: str, glob: str, multiline: bool,
             fields: list[T.StructField], temp: list[str], scratch: list[str]) -> tuple[DataFrame, list[str]]:
    """Records as a struct ``_r`` with the field names ``temp``, the text of what
    did not parse as ``_bad``, the file's path, and the columns of the folders.

    All goes through the JSON reader, which streams the records of a file.  Names
    that differ only by case cannot be columns of one scan here: then a side
    session that minds the case reads and renames them, and what it gives is
    written to the shared scratch folder, in a place that ``scratch`` then names.
    """
    alike = len({f.name.lower() for f in fields}) < len(fields)
    reader = _case_sensitive(spark) if alike else spark
    names = {f.name for f in fields}
    rows = (reader.read.option("pathGlobFilter", glob).option("basePath", base)
            .schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())]))
            .option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path))
    folders = [c for c in rows.columns if c not in names and c != CORRUPT]
    record = F.struct(*[F.col(f"`{f.name}`").alias(t) for f, t in zip(fields, temp)])
    rows = rows.select(record.alias("_r"), F.col(CORRUPT).alias("_bad"),
                       F.col("_metadata.file_path").alias("_file"), *folders)
    if alike:
        place = scratch_path(spark, "landing-records")
        scratch.append(place)
        rows.write.parquet(place)
        rows = spark.read.schema(rows.schema).parquet(place)
    return rows, folders


def _scan(spark: SparkSession, base: str, batch_id, glob: str, multiline: bool,
          schema: T.StructType | None, type_hints: T.StructType | None,
          overrides: dict[str, str] | None, scratch: list[str]):
    """(records, folder columns, normalised name → temporary names)."""
    ids = [batch_id] if isinstance(batch_id, str) else list(batch_id or [])
    path = [f"{base.rstrip('/')}/batch_id={b}" for b in ids] if ids else base
    try:
        raw = schema or infer_landing_schema(spark, path, base=base, glob=glob, multiline=multiline)
        fields = _typed([f for f in raw.fields if f.name != CORRUPT], type_hints, overrides)
        if not fields:
            raise LandingError(f"no readable JSON records under {path}")
        groups = normalized_names([f.name for f in fields], overrides)
        place = {f.name: f"c{i}" for i, f in enumerate(fields)}
        rows, folders = _records(spark, path, base, glob, multiline, fields,
                                 [place[f.name] for f in fields], scratch)
    except AnalysisException as e:  # missing folder, or nothing to infer a schema from
        raise LandingError(f"cannot read landing data at {path}: {e}") from e
    return rows, folders, {norm: [place[r] for r in raws] for norm, raws in groups.items()}


def read_landing(spark: SparkSession, base: str, *, batch_id: str | list[str] | None = None,
                 glob: str = "*.json", multiline: bool = True,
                 schema: T.StructType | None = None,
                 type_hints: T.StructType | None = None,
                 section_pattern: str = SECTION_FILE, section_col: str = "seccion",
                 overrides: dict[str, str] | None = None, on_error: str = "fail",
                 scratch: list[str] | None = None) -> DataFrame:
    """Read landing batches (all, or some) as a normalised bronze frame.

    Pass ``schema`` to skip the inference pass.  ``multiline=False`` reads JSON
    lines (one record per line, splittable) instead of one array per file.
    ``batch_id`` may be one id or a list (only those batch folders are read).
    ``type_hints`` (e.g. the existing bronze schema) widens types that inference
    degrades for this batch (see ``widen``).

    Raises ``LandingError`` when a folder is missing or holds no readable record.
    What does not parse makes the read fail when it runs; ``on_error="divert"``
    leaves it to ``landing_rejects``.  Scratch folders the frame is read from are
    added to ``scratch``, for a caller who deletes them when done with it.
    """
    if on_error not in ("fail", "divert"):
        raise ValueError("on_error is 'fail' or 'divert'")
    rows, folders, groups = _scan(spark, base, batch_id, glob, multiline, schema, type_hints, overrides,
                                  [] if scratch is None else scratch)
    # What was read of a field is named as well: the JSON reader refuses a scan
    # of the bad text alone, which a mere count of the rows would come to.
    some = F.to_json(F.struct(F.col(f"_r.{next(iter(groups.values()))[0]}")))
    if on_error == "fail":
        what = F.concat(F.lit("landing data that does not parse in "), F.col("_file"), F.lit(": "),
                        F.col("_bad"), F.lit(", read as "), F.coalesce(some, F.lit("nothing")))
        keep = F.raise_error(what).cast("boolean")
    else:
        keep = F.length(some) < 0
    rows = rows.filter(F.when(F.col("_bad").isNull(), True).otherwise(F.coalesce(keep, F.lit(False))))
    section = F.col(section_col) if section_col in folders else _section_of("_file", section_pattern)
    # the later of several raw keys with one normal form wins where it is set
    # (as text, if they are of several types)
    types = {f.name: f.dataType for f in rows.schema["_r"].dataType.fields}

    def value(temps: list[str]) -> Column:
        mixed = len({types[t].simpleString() for t in temps}) > 1
        return F.coalesce(*[F.col(f"_r.{t}").cast("string") if mixed else F.col(f"_r.{t}")
                            for t in reversed(temps)])

    cols = [value(temps).alias(norm) for norm, temps in groups.items()
            if norm not in ("batch_id", section_col)]
    return rows.select(*cols, "batch_id", section.alias(section_col))


def landing_rejects(spark: SparkSession, base: str, *, batch_id: str | list[str] | None = None,
                    glob: str = "*.json", multiline: bool = True,
                    schema: T.StructType | None = None,
                    type_hints: T.StructType | None = None) -> DataFrame:
    """What does not parse: batch, file and text of each such record (or file,
    when none of its records can be told apart), and what could be read of it.

    The list is written to the shared scratch folder first: the JSON reader does
    not give the text of bad records alone.
    """
    rows, _, _ = _scan(spark, base, batch_id, glob, multiline, schema, type_hints, None, [])
    return materialize(rows.filter(F.col("_bad").isNotNull()).select(
        "batch_id", F.col("_file").alias("path"), F.col("_bad").alias("record"),
        F.to_json("_r").alias("read")), "rejects")


def colliding_counts(spark: SparkSession, base: str, *, batch_id: str | list[str] | None = None,
                     glob: str = "*.json", multiline: bool = True,
                     overrides: dict[str, str] | None = None) -> DataFrame:
    """For each normal key that several raw keys have: those raw keys (sorted), the
    rows that set any of them, and the rows that set more than one, of which
    ``read_landing`` keeps one value only."""
    raw = infer_landing_schema(spark, [f"{base.rstrip('/')}/batch_id={b}" for b in (
        [batch_id] if isinstance(batch_id, str) else batch_id)] if batch_id else base,
        base=base, glob=glob, multiline=multiline)
    groups = normalized_names([f.name for f in raw.fields if f.name != CORRUPT], overrides)
    rows, _, places = _scan(spark, base, batch_id, glob, multiline, raw, None, overrides, [])
    several = {norm: temps for norm, temps in places.items() if len(temps) > 1}
    if not several:
        return spark.createDataFrame([], "clave string, formas array<string>, filas long, filas_con_varias long")

    def how_many(temps: list[str]) -> Column:
        n = F.lit(0)
        for t in temps:
            n = n + F.col(f"_r.{t}").isNotNull().cast("int")
        return n
    counted = rows.agg(*[x.alias(f"{k}{i}") for i, temps in enumerate(several.values()) for k, x in (
        ("any", F.count_if(how_many(temps) > 0)), ("many", F.count_if(how_many(temps) > 1)))])
    return counted.select(F.explode(F.array(*[F.struct(
        F.lit(norm).alias("clave"), F.array(*[F.lit(x) for x in sorted(groups[norm])]).alias("formas"),
        F.col(f"any{i}").alias("filas"), F.col(f"many{i}").alias("filas_con_varias"))
        for i, norm in enumerate(several)])).alias("x")).select("x.*")


def landing_files(spark: SparkSession, base: str, glob: str = "*.json",
                  section_pattern: str = SECTION_FILE,
                  section_col: str = "seccion") -> DataFrame:
    """One row per landing file: batch, section, size.  File contents are not read
    (the ``binaryFile`` source skips content when it is not selected)."""
    f = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
         .option("basePath", base).load(base))
    section = F.col(section_col) if section_col in f.columns else F.regexp_extract(
        "path", section_pattern, 1)  # paths of this source come without escapes
    return f.select("batch_id", section.alias(section_col), "path", "length")


def landing_batches(files: DataFrame) -> DataFrame:
    return files.select("batch_id").distinct()


def landing_completeness(files: DataFrame, expected: list[str],
                         section_col: str = "seccion") -> DataFrame:
    """Per batch: sections found, sections missing from ``expected``, and a flag."""
    g = files.groupBy("batch_id").agg(F.sort_array(F.collect_set(section_col)).alias("_found"))
    exp = F.array(*[F.lit(x) for x in sorted(expected)])
    return g.select("batch_id",
                    F.size("_found").alias("secciones"),
                    F.array_except(exp, F.col("_found")).alias("faltantes"),
                    (F.size(F.array_except(exp, F.col("_found"))) == 0).alias("completo"))


def write_landing(df: DataFrame, base: str, *, batch_col: str = "batch_id",
                  section_col: str = "seccion", id_col: str, chunk_rows: int = 10000) -> None:
    """Write ``df`` as landing JSON arrays: ``batch_id=/seccion=/chunk=`` folders,
    one file holding one JSON array per (batch, section, chunk).

    Each (batch, section) is cut by a hash of the id into as many chunks as its
    rows need, so there are few folders and no array grows with the data.
    """
    payload = [c for c in df.columns if c not in (batch_col, section_col)]
    keys = [batch_col, section_col]
    sizes = df.groupBy(*keys).agg(F.ceil(F.count("*") / chunk_rows).alias("_chunks"))
    arrays = (df.join(sizes, keys)
              .withColumn("chunk", F.pmod(F.xxhash64(id_col), F.col("_chunks")))
              .groupBy(*keys, "chunk")
              .agg(F.to_json(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in payload])))
                   .alias("value")))
    arrays.write.mode("overwrite").partitionBy(*keys, "chunk").text(base)


def write_landing_lines(df: DataFrame, base: str, *, batch_col: str = "batch_id",
                        section_col: str = "seccion") -> None:
    """Write ``df`` as JSON lines in ``batch_id=/seccion=`` folders: splittable,
    and written without gathering anything."""
    df.write.mode("overwrite").partitionBy(batch_col, section_col).json(base)


def publish_landing(spark: SparkSession, written: str, base: str, batch_col: str = "batch_id",
                    section_col: str = "seccion") -> int:
    """Move what ``write_landing`` or ``write_landing_lines`` has written to the
    landing layout proper, ``<base>/batch_id=<day>/<section>.json`` (further files of a
    section are ``<section>~1.json``, ...); returns the number of files.

    Each file appears whole, by a rename on the file system; a section's files of an
    earlier delivery go first.  Only names pass through the driver.
    """
    moved = 0
    for batch in subfolders(spark, written):
        for folder in subfolders(spark, f"{written}/{batch}"):
            section = folder.removeprefix(f"{section_col}=")
            if not batch.startswith(f"{batch_col}=") or section == folder:
                continue
            old = [n for n in subpaths(spark, f"{base}/{batch}")
                   if n == f"{section}.json" or n.startswith(f"{section}~") and n[len(section) + 1:-5].isdigit()]
            for name in old:
                delete_path(spark, f"{base}/{batch}/{name}")
            for i, path in enumerate(_part_files(spark, f"{written}/{batch}/{folder}")):
                move_path(spark, path, f"{base}/{batch}/{section}{f'~{i}' if i else ''}.json")
                moved += 1
    return moved


def _part_files(spark: SparkSession, folder: str) -> list[str]:
    own = [f"{folder}/{n}" for n in subpaths(spark, folder) if n.startswith("part-")]
    return own + [f for sub in subfolders(spark, folder) for f in _part_files(spark, f"{folder}/{sub}")]
