"""What the text operators share: column expressions, and one Python function per text inside Arrow batches."""

import pyarrow as pa
from pyspark.sql import functions as F

# The word and letter definitions of the contracts.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ROWS = 256
COPIES = 10_000


def whole(text):
    """The text, empty where null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text):
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def sha256_hex(text):
    return F.sha2(text.cast("binary"), 256)


def pairs(docs, id_col, text_col):
    """The two columns an operator reads, under names of its own, so that no other column can clash."""
    return docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))


def numbered_copies(df, copies, out):
    """Every row as often as `copies` says, numbered from 1; however many, only short arrays are held."""
    last = F.least(F.col(copies), F.col("_from") + (COPIES - 1))
    runs = df.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), copies, F.lit(COPIES).cast("bigint"))))
    return runs.withColumn(out, F.explode(F.sequence("_from", last))).drop("_from")


def in_slices(batches, rows=ROWS):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_texts(docs, id_col, text_col, start, fields):
    """One row per document: its id, then `fields` ("name type, ...").

    `start()` runs once per task and returns a function from a text to a tuple of those fields. Texts are whole; a null
    text is empty. Only a slice of an Arrow batch is held as Python strings at a time.
    """
    source = pairs(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {fields}"

    def run(batches):
        work = start()
        for part in in_slices(batches):
            rows = [work(t) for t in part.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            arrays = [pa.array(list(c), type=t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=["doc_id", *names])

    arrow = _arrow_fields(docs.sparkSession, fields)
    names, types = [n for n, _ in arrow], [t for _, t in arrow]
    return source.mapInArrow(run, schema)


def _arrow_fields(spark, fields):
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return [(f.name, to_arrow_type(f.dataType)) for f in _parse_datatype_string(fields).fields]
