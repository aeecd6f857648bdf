"""Fill-in-the-middle: documents cut into prefix, middle and suffix and put in another order.

A text is cut into units, a unit being a word with the white space before it or
white space at the end.  Two hashes of the seed and the document's id choose
two places between units, a third whether the document is changed at all, a
fourth its form: ``psm`` gives prefix, suffix and middle behind their marks,
``spm`` suffix, prefix and middle.  ``plain`` is the text as it is.

The work is SQL that runs in DuckDB inside ``mapInArrow``: every slice of a
batch is registered as a table and the result goes back as Arrow, so that no
row passes through Python by itself.  Each worker has one connection of one
thread, in memory, which writes no file; a slice is SLICE_CHARS long, or one
text.

Corner cases: a null text is empty; an empty text, and one that holds a mark
already, is plain; a null id is hashed as an empty one; white space alone is
one unit; a place before the first unit or behind the last leaves a part empty;
a very long text is cut whole, with memory in proportion to it; repeated rows
get equal results; there are no ties; an empty table gives no rows.  Only the
id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.llm import common

SEED, RATE, SPM = 42, 50, 80
MARKS = ("<P>", "<S>", "<M>")
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def made_sql(seed: int, rate: int, spm: int, marks: tuple[str, str, str]) -> str:
    """From a table ``batch`` of doc_id and text the units, the form and the new text."""
    p, s, m = map(quoted, marks)
    number = ", ".join(f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
    return f"""
    WITH cut AS (
      SELECT doc_id, text, regexp_extract_all(text, {quoted(UNIT)}) AS units,
             sha256({quoted(f"{seed}:")} || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
      FROM (SELECT doc_id, coalesce(text, '') AS text FROM batch)
    ), hashed AS (
      SELECT doc_id, text, units, len(units) AS n, {number} FROM cut
    ), placed AS (
      SELECT doc_id, text, units, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, {p}) OR contains(text, {s}) OR contains(text, {m}) OR h3 % 100 >= {rate} THEN 'plain'
                  WHEN h4 % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form
      FROM hashed
    ), parted AS (
      SELECT doc_id, text, n, form,
             CASE WHEN form <> 'plain' THEN array_to_string(list_slice(units, 1, a), '') END AS prefix,
             CASE WHEN form <> 'plain' THEN array_to_string(list_slice(units, a + 1, b), '') END AS middle,
             CASE WHEN form <> 'plain' THEN array_to_string(list_slice(units, b + 1, n), '') END AS suffix
      FROM placed
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(length(prefix) AS BIGINT) AS prefix_chars, CAST(length(middle) AS BIGINT) AS middle_chars,
           CASE form WHEN 'plain' THEN text
                     WHEN 'psm' THEN concat({p}, prefix, {s}, suffix, {m}, middle)
                     ELSE concat({s}, suffix, {p}, prefix, {m}, middle) END AS output
    FROM parted"""


def restored_sql(marks: tuple[str, str, str], carried: list[str]) -> str:
    """From a table ``batch`` of form and output the text before; no part holds a mark, so the marks cut the output."""
    p, s, m = map(quoted, marks)
    names = ", ".join(f'"{c}"' for c in carried)
    return f"""
    SELECT {names}, CASE form
        WHEN 'plain' THEN output
        WHEN 'psm' THEN concat(substr(split_part(output, {s}, 1), {len(marks[0]) + 1}), split_part(output, {m}, 2), split_part(split_part(output, {s}, 2), {m}, 1))
        ELSE concat(split_part(split_part(output, {p}, 2), {m}, 1), split_part(output, {m}, 2), substr(split_part(output, {p}, 1), {len(marks[1]) + 1}))
      END AS restored
    FROM batch"""


@lru_cache(1)
def connection():
    """The worker's own database: one thread, nothing on disk."""
    import duckdb

    return duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "2GB", "temp_directory": ""})


def in_duckdb(df: DataFrame, sql: str, schema: str, text: str) -> DataFrame:
    """``sql`` over the table ``batch``, run on every slice of ``df``."""
    at = df.columns.index(text)
    out = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        db, arrow = connection(), to_arrow_schema(out)
        for batch in batches:
            for part in common.slices(batch, batch.column(at)):
                db.register("batch", pa.Table.from_batches([part]))
                made = db.execute(sql).to_arrow_table().cast(arrow)
                db.unregister("batch")
                yield from made.to_batches()
        common.give_back()

    return df.mapInArrow(run, out)


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, marks: tuple[str, str, str] = MARKS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain) and output.

    ``rate`` is the per cent of documents to change, ``spm`` the per cent of
    those that take this form.  No mark may be part of another, or end as one
    begins.
    """
    if any(not a or (i != j and a in b) for i, a in enumerate(marks) for j, b in enumerate(marks)) or any(a[-k:] == b[:k] for a in marks for b in marks for k in range(1, min(len(a), len(b)))):
        raise ValueError("the marks must not be empty, hold or overlap each other")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return in_duckdb(rows, made_sql(seed, rate, spm, marks), schema, "text")


def restore(made: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """The columns of ``fill_in_middle`` and ``restored``, the text rebuilt from form and output alone."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema) + ", restored string"
    return in_duckdb(made, restored_sql(marks, made.columns), schema, "output")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = restore(fill_in_middle(common.documents(spark, sf_dir)))
    digests = [F.sha2(F.encode(c, "UTF-8"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return rebuilt.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_transform(regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'), lambda x: length(x)) AS sizes,
         sha256('42:' || CAST(doc_id AS VARCHAR)) AS h
  FROM documents
), d AS (
  SELECT doc_id, text, sizes, len(sizes) AS n,
         list_transform([0, 1, 2, 3], lambda i: CAST('0x' || h[8 * i + 1 : 8 * i + 8] AS BIGINT)) AS hs
  FROM u
), f AS (
  SELECT doc_id, text, n,
         coalesce(list_sum(sizes[1 : least(hs[1] % (n + 1), hs[2] % (n + 1))]), 0) AS a,
         coalesce(list_sum(sizes[1 : greatest(hs[1] % (n + 1), hs[2] % (n + 1))]), 0) AS b,
         CASE WHEN n = 0 OR regexp_matches(text, '<[PSM]>') OR hs[3] % 100 >= 50 THEN 'plain' WHEN hs[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), o AS (
  SELECT doc_id, n, form, text, CAST(a AS BIGINT) AS a, CAST(b - a AS BIGINT) AS m,
         substr(text, 1, CAST(a AS BIGINT)) AS p, substr(text, CAST(a AS BIGINT) + 1, CAST(b - a AS BIGINT)) AS mid, substr(text, CAST(b AS BIGINT) + 1) AS s
  FROM f
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN m END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || mid ELSE '<S>' || s || '<P>' || p || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM o
"""
