"""Lines that many documents share: two Bloom filters, then an exact count of suspects only."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cardwatch.llm import bloom
from cardwatch.llm.common import row_key, slices, table, text_bytes
from cardwatch.session import saved

LEAST_CHARS, LEAST_DOCS = 1, 10
#: Stripped from a key's ends.
SPACE = b" \t\n\x0b\x0c\r"


def keys(text: bytes) -> list[bytes]:
    """Key of every line: white space off both ends, A-Z lower-cased."""
    return [line.strip(SPACE) for line in text.lower().split(b"\n")]


def _counted(key: bytes, least_chars: int) -> bool:
    return len(key) >= least_chars and (least_chars < 2 or len(key.decode()) >= least_chars)


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_chars: int = LEAST_CHARS,
                        least_docs: int = LEAST_DOCS, keep: str = "none", most_log2: int = bloom.MOST_LOG2) -> DataFrame:
    """All columns of docs, the text without repeated lines, and n_lines, n_dropped (last columns).

    A key found in at least ``least_docs`` rows loses all its lines; with ``keep="first"`` its first
    line in the document of the smallest doc_id stays. Null and empty texts are one empty line and
    stay null or empty; keys shorter than ``least_chars`` code points stay. Repeated rows count as
    separate documents. Columns of docs named n_lines or n_dropped are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped") if {"n_lines", "n_dropped"} & set(docs.columns) else docs
    n_lines = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1
    total = docs.agg(F.sum(n_lines.cast("long"))).first()[0] or 0

    def hashed(found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))

    def line_hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in slices(batch, 0):
            yield hashed([k for t in text_bytes(part.column(0)) for k in set(keys(t)) if _counted(k, least_chars)])

    repeated = bloom.twice_seen(docs.select(text), line_hashes, bloom.log2_bits(total, most_log2))
    shared = docs.sparkSession.sparkContext.broadcast(repeated)  # at most 2^most_log2 bits

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                rows, found = [], []
                for i, t in enumerate(text_bytes(part.column(2))):
                    own = [k for k in set(keys(t)) if _counted(k, least_chars)]
                    rows += [i] * len(own)
                    found += own
                if not found:
                    continue
                maybe = np.flatnonzero(bloom.holds(shared.value, hashed(found)))
                at = pa.array(np.array(rows)[maybe])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at),
                     pa.array([found[i] for i in maybe], pa.binary())], ["_row", "_id", "_key"])

    kind = docs.schema[doc_id].dataType.simpleString()
    marked = docs.withColumn("_row", row_key(F.col(doc_id), F.col(text)))
    rows = marked.select("_row", F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(
        suspects, f"_row binary, _id {kind}, _key binary")
    # both sides of the join below are files, so a key of very many rows can be split
    rows = saved(rows, "suspects")
    many = saved(rows.groupBy("_key").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
                 .filter(F.col("_n") >= least_docs), "repeated")
    stays = F.col("_id").eqNullSafe(F.col("_first")) if keep == "first" else F.lit(False)
    lost = (rows.join(many, "_key").groupBy("_row")
            .agg(F.collect_set(F.struct(F.col("_key").alias("key"), stays.alias("stays"))).alias("_lost")))
    joined = marked.join(lost, "_row", "left").select(*docs.columns, "_lost")
    place = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                texts, lost_keys = part.column(place).to_pylist(), part.column(part.num_columns - 1).to_pylist()
                n, dropped = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                for i, (t, own) in enumerate(zip(texts, lost_keys)):
                    n[i] = (t or "").count("\n") + 1
                    if own:
                        gone, spare = {x["key"] for x in own}, {x["key"] for x in own if x["stays"]}
                        left = []
                        for line, k in zip(t.split("\n"), keys(t.encode())):
                            if k not in gone or k in spare:
                                left.append(line)
                                spare.discard(k)
                        dropped[i], texts[i] = n[i] - len(left), "\n".join(left)
                columns = part.columns[:-1]
                columns[place] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(dropped)],
                                                 names=[*part.schema.names[:-1], "n_lines", "n_dropped"])

    schema = StructType([*docs.schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return joined.mapInArrow(cut, schema)


def op3_line_dedup(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key AS gone FROM (SELECT DISTINCT doc_id, key FROM k WHERE key != '') GROUP BY key HAVING count(*) >= 10)
SELECT doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON key = gone GROUP BY doc_id"""
