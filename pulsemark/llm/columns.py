"""Add columns that are computed in Arrow batches from a text column, beside any other columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemark.llm.text import gives_back, light_batches, released

#: From the texts of a batch: parts of its rows (first, after the last) with the new columns of these rows.
Make = Callable[[pa.Array], Iterator[tuple[int, int, list[pa.Array]]]]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def add_columns(docs: DataFrame, keep: Sequence[str], added: str, start: Callable[[], Make],
                text_column: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and those of the schema ``added``.

    ``start`` is called once in each task and gives the function that computes them. A null text counts as
    empty. The frame may have any further columns; a kept column that has the name of an added one is refused.
    """
    new = T._parse_datatype_string(added)
    clash = sorted(set(keep) & set(new.names))
    if clash:
        raise ValueError(f"kept columns have the names of new ones: {', '.join(clash)}")
    # Kept columns travel under numbers, so that none is taken for the text. A text that is kept travels once.
    kinds = [f.dataType for f in docs.select(*[F.col(quoted(c)) for c in keep]).schema.fields]
    sent = [None if c == text_column and kind == T.StringType() else i for i, (c, kind) in enumerate(zip(keep, kinds))]
    others = [i for i in sent if i is not None]
    places = [0 if i is None else 1 + others.index(i) for i in sent]
    asked = docs.select(F.col(quoted(text_column)).cast("string").alias("t"),
                        *[F.col(quoted(keep[i])).alias(f"k{i}") for i in others])
    schema = T.StructType([*(T.StructField(c, kind) for c, kind in zip(keep, kinds)), *new.fields])
    names = schema.names

    def run(batches):
        make = start()
        for batch in released(batches):
            texts = pc.fill_null(batch.column(0), "")
            rest = [batch.column(k) for k in places]
            for lo, hi, arrays in make(texts):
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in rest), *arrays], names)

    light_batches(docs.sparkSession)
    return asked.mapInArrow(gives_back(run), schema)
