"""Registry scans, manifests, JSON lines, append-only logs and snapshots."""

from __future__ import annotations

import gzip

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

#: Fixed header spellings of the registry (first non-empty one wins).
REGISTRY_HEADERS = {
    "organisation_number": ("organisasjonsnummer", "Organisasjonsnummer"), "name": ("navn", "Navn"),
    "legal_form": ("organisasjonsform.kode", "Organisasjonsform.kode"), "employees": ("antallAnsatte", "Antall ansatte"),
    "bankrupt": ("konkurs", "Konkurs"), "liquidating": ("underAvvikling", "Under avvikling"),
    "municipality": ("forretningsadresse.kommune", "Forretningsadresse.kommune"),
    "municipality_number": ("forretningsadresse.kommunenummer", "Forretningsadresse.kommunenummer"),
    "industry_code": ("naeringskode1.kode", "Næringskode1.kode"), "industry_label": ("naeringskode1.beskrivelse", "Næringskode1.beskrivelse"),
    "website": ("hjemmeside", "Hjemmeside"), "email": ("epostadresse", "Epostadresse"),
    "latest_submitted_accounts": ("sisteInnsendteAarsregnskap", "Siste innsendte årsregnskap"),
}
#: Fixed names that a manifest may use for the organisation number.
MANIFEST_KEYS = ("organisation_number", "organization_number", "organisasjonsnummer", "orgnr", "org_number")


def head(spark: SparkSession, path: str, size: int = 65_536) -> bytes:
    """First bytes of a file, by any path Spark reads; unpacked if gzip."""
    raw = bytes(spark.read.format("binaryFile").load(path).select(F.substring("content", 1, size)).first()[0])
    if raw[:2] == b"\x1f\x8b":
        import zlib

        raw = zlib.decompressobj(31).decompress(raw)
    return raw


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry rows as strings: gzip by magic bytes, a BOM passed over, JSON
    lines if the first character is a brace or the name says so, else CSV whose
    delimiter is the commonest of ; , and tab in the header line. Well-named
    files are read splittably by Spark; gzip files without the ending are
    unpacked whole by one task."""
    sample = head(spark, path)
    first = sample.decode("utf-8-sig", "replace").lstrip()
    name = path.lower()
    json_lines = first.startswith("{") or ".jsonl" in name
    is_gzip = bytes(spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 2)).first()[0]) == b"\x1f\x8b"
    if is_gzip and not name.endswith(".gz"):
        def lines(batches):
            import pyarrow as pa

            for b in batches:
                for raw in b.column("content").to_pylist():
                    text = gzip.decompress(raw).decode("utf-8-sig")
                    yield pa.RecordBatch.from_arrays([pa.array(text.splitlines(), pa.string())], ["value"])

        text = spark.read.format("binaryFile").load(path).select("content").mapInArrow(lines, "value string").repartition(spark.sparkContext.defaultParallelism)
        rdd = text.rdd.map(lambda r: r[0])
        if json_lines:
            return spark.read.json(rdd)
        source = rdd
    else:
        if json_lines:
            return spark.read.json(path)
        source = path
    line = first.splitlines()[0] if first else ""
    sep = max(";,\t", key=line.count)
    if isinstance(source, str):
        return spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(source)
    names = [c.strip('"') for c in line.split(sep)]
    return spark.read.option("sep", sep).schema(", ".join(f"`{c}` string" for c in names)).csv(source).where(F.col(f"`{names[0]}`") != names[0])


def _first(df: DataFrame, names: tuple[str, ...]) -> Column:
    return F.coalesce(*(F.nullif(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names if n in df.columns), F.lit(""))


def normalise_registry(raw: DataFrame) -> DataFrame:
    """The 13 registry columns plus `raw`; rows without a 9-character number go."""
    cols = {k: F.trim(_first(raw, v)) for k, v in REGISTRY_HEADERS.items()}
    cols["employees"] = F.try_to_number(cols["employees"], F.lit("999999999")).cast("int")
    cols |= {k: F.lower(cols[k]) == "true" for k in ("bankrupt", "liquidating")}
    packed = F.create_map(*(x for c in raw.columns for x in (F.lit(c), F.col(f"`{c}`").cast("string"))))
    return raw.select(*(v.alias(k) for k, v in cols.items()), packed.alias("raw")).where(F.length("organisation_number") == 9)


def clean_number(col: Column, position: Column) -> Column:
    """Digits only where nine remain; input_N for nothing; else as given."""
    digits = F.regexp_replace(F.coalesce(col, F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) == 9, digits).when(F.trim(F.coalesce(col, F.lit(""))) == "", F.concat(F.lit("input_"), position)).otherwise(F.trim(col))


def _numbered(lines: DataFrame) -> DataFrame:
    """lines with their place 0, 1, ...: the lines of each read task are counted first."""
    each = lines.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    sizes = each.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    one = W.partitionBy(F.lit(1)).orderBy("_part")  # one row a task
    ahead = sizes.select("_part", "first", (F.sum("n").over(one) - F.col("n")).alias("ahead"))
    # lines that a filter drops leave gaps in _at, so places are counted within the task
    place = F.row_number().over(W.partitionBy("_part").orderBy("_at")) - 1
    return each.join(ahead, "_part").select("value", (F.col("ahead") + place).alias("position"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(position from 1, organisation_number) of .json, .jsonl or .txt manifests; a
    repeated number raises an error when the rows are read."""
    if path.endswith(".json"):
        whole = spark.read.text(path, wholetext=True)
        listed = F.coalesce(F.from_json("value", "organisation_numbers array<string>")["organisation_numbers"], F.from_json("value", "array<string>"))
        rows = whole.select(F.posexplode(listed).alias("position", "given"))
    else:
        lines = _numbered(spark.read.text(path).where(F.trim("value") != ""))
        keys = F.coalesce(*(F.get_json_object("value", f"$.{k}") for k in MANIFEST_KEYS))
        rows = lines.select("position", F.when(F.ltrim("value").startswith("{"), keys).otherwise(F.trim("value")).alias("given"))
    rows = rows.withColumn("position", F.col("position").cast("long"))
    rows = rows.select((F.col("position") + 1).alias("position"), clean_number(F.col("given"), F.col("position") + 1).alias("organisation_number"))
    times = F.count("*").over(W.partitionBy("organisation_number"))
    return rows.withColumn("organisation_number", F.when(times > 1, F.raise_error(F.concat(F.lit("repeated organisation number "), F.col("organisation_number")))).otherwise(F.col("organisation_number")))


def read_json_lines(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def write_json_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """All files or none: Spark's committer moves them when the job is done."""
    df.write.mode("overwrite").option("compression", compression).json(path)


def append_attempts(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("organisation_number").parquet(path)


def read_attempts(spark: SparkSession, path: str, *, organisation: str | None = None, run: str | None = None, route: str | None = None) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "organisation_number" else f.dataType) for f in spark.read.parquet(path).schema])
    df = spark.read.schema(schema).parquet(path)  # the partition column stays text: leading zeros count
    for name, value in (("organisation_number", organisation), ("run_id", run), ("route", route)):
        if value is not None:
            df = df.where(F.col(name).cast("string") == value)
    return df


def serve_snapshot(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Stored responses under the live contract: missing urls have status 0."""
    r = responses.select("url", "status", "body", "retrieved_at")
    return requests.join(r, "url", "left").select(requests["*"], F.coalesce("status", F.lit(0)).alias("status"), "body", F.sha2(F.col("body").cast("binary"), 256).alias("content_sha256"), "retrieved_at")


def text_digest(content: Column) -> Column:
    """sha256 of a file's bytes with CRLF line ends read as LF."""
    single = F.decode(content, "ISO-8859-1")  # a character a byte
    return F.sha2(F.encode(F.replace(single, F.lit("\r\n"), F.lit("\n")), "ISO-8859-1"), 256)


def fetch_state(status: Column) -> Column:
    """How an official module classifies a response."""
    return F.when(status == 200, "available").when(status.isin(404, 410), "not_found").when(status.isin(401, 403, 429), "blocked").otherwise("source_error")
