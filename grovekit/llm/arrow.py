"""Small helpers for functions that map Arrow batches."""

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

_ROWS = 512


def arrow_schema(ddl):
    return to_arrow_schema(_parse_datatype_string(ddl))


def slices(batches, rows=_ROWS):
    """Batches of a bounded number of rows, so that long texts never pile up in a task."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def to_batch(schema, columns):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
