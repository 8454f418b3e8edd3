"""Helpers that run a function over the whole texts of a DataFrame in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: characters of text that one call of a batch function gets; a longer text comes alone
BATCH_CHARS = 1 << 20


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_of(df: DataFrame, names, keep=()) -> list[str]:
    """Columns of ``df`` that stay beside new columns ``names``; a new column replaces one of the same name."""
    taken = {n.lower() for n in names} - {k.lower() for k in keep}
    return [c for c in df.columns if c.lower() not in taken]


def parts(texts: list, limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` characters."""
    lo, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= limit:
            yield lo, k + 1
            lo, size = k + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def map_texts(
    df: DataFrame, text_col: str, schema: T.StructType, make: Callable[[], Callable[[list], dict]], drop_text: bool = True
) -> DataFrame:
    """``df`` with the columns of ``schema`` that ``make()(texts)`` gives for each batch of whole texts.

    ``make`` runs once in each task (it loads tokenisers or models); its function gets a list of
    ``str | None`` and returns a dict of column name to a sequence of that length. Rows keep their
    order and their partition: there is no shuffle.
    """
    keep = free_of(df, schema.names, keep=[text_col])
    src = df.select(*[F.col(f"`{c}`") for c in keep])
    at = next(i for i, c in enumerate(keep) if c.lower() == text_col.lower())
    out_cols = [i for i in range(len(keep)) if not (drop_text and i == at)]
    out = T.StructType([src.schema[i] for i in out_cols] + list(schema))
    new = T.StructType(list(schema))

    def run(it):
        from pyspark.sql.pandas.types import to_arrow_schema

        fn, arrow, kinds = make(), to_arrow_schema(out), to_arrow_schema(new)
        for batch in it:
            texts = batch.column(at).to_pylist()
            for lo, hi in parts(texts):
                got = fn(texts[lo:hi])
                cols = [batch.column(i).slice(lo, hi - lo) for i in out_cols]
                cols += [pa.array(got[f.name], type=f.type) for f in kinds]
                yield pa.RecordBatch.from_arrays(
                    [c if c.type == f.type else c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow
                )

    return src.mapInArrow(run, out)
