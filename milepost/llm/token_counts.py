"""Token counts of whole texts."""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from milepost.llm.arrow import by_bytes, frugal, schema_of, utf8
from milepost.llm.tokens import BATCH_BYTES, encoder


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 2048, batch: int = BATCH_BYTES) -> DataFrame:
    """`docs` without its text, with n_bytes, n_tokens and over_limit (n_tokens > limit).

    Encoded batch by batch in Arrow functions that return lengths only. Batches are cut by
    bytes, not by rows: texts are gathered up to `batch` bytes, however many that are, and a longer text
    is split at safe boundaries, so memory does not depend on the length of a text. No shuffle.

    A null text counts as empty: 0 bytes, 0 tokens. Rows keep their other columns,
    nulls and repeats included; columns named like a result are replaced. An empty
    table gives an empty result.
    """
    new = schema_of("n_bytes bigint, n_tokens bigint, over_limit boolean")
    kept = [c for c in docs.columns if c.lower() not in {f.name for f in new.fields} | {text.lower()}]
    out = StructType([docs.schema[c] for c in kept] + new.fields)
    schema = to_arrow_schema(out)

    def run(batches):
        count = encoder(path, lengths_only=True).encode
        for table in by_bytes(batches, len(kept), batch):
            texts = utf8(table.column(len(kept)))
            n = count(texts)
            found = [[len(t or b"") for t in texts], n, [x > limit for x in n]]
            columns = [table.column(i).combine_chunks() for i in range(len(kept))] + [pa.array(v, f.type) for v, f in zip(found, list(schema)[len(kept) :])]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return docs.select(*[f"`{c}`" for c in kept], f"`{text}`").mapInArrow(frugal(run), out)
