"""Choosing a reader by file extension, for whole folders at once."""

from pyspark.sql import functions as F

SUPPORTED = (".docx", ".pdf", ".xlsx", ".csv")  # fixed values


def any_case(extension):
    """Glob that matches an extension in any letter case: '.csv' -> '*.[cC][sS][vV]'."""
    return "*." + "".join(f"[{ch}{ch.upper()}]" for ch in extension.lstrip("."))


def list_files(spark, paths):
    """(path, extension, supported) for every file under the paths; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path")
    extension = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return files.select("path", extension.alias("extension"), extension.isin(*SUPPORTED).alias("supported"))


def rejects(files, paged=None):
    """Files no reader takes, with the reason. A PDF is taken only if `paged` (doc) names it by path or base name: its
    pages must come from an external extractor."""
    reason = F.concat(F.lit("Unsupported file format: "), "extension")
    out = files.where(~F.col("supported")).select("path", reason.alias("reason"))
    pdf = files.where("extension = '.pdf'").select("path")
    if paged is not None:
        named = paged.select("doc").distinct()
        pdf = pdf.join(named, F.col("path") == F.col("doc"), "left_anti")
        pdf = pdf.join(named, base_name(F.col("path")) == F.col("doc"), "left_anti")
    return out.unionByName(pdf.withColumn("reason", F.lit("PDF pages were not supplied as page tables")))


def base_name(path):
    """Name of the file a full path points to; a plain name stays as it is."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def decoded(file_path):
    """Scan metadata gives paths in URL form; other readers give them plain."""
    plain = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def binary_files(spark, paths, extension):
    """(path, content) of the files with one extension; each file is one record."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", any_case(extension))
        .load(paths)
        .select("path", "content")
    )
