"""Makes difficult copies of the smallest supplied tables: nulls in every column, no rows, every row twice, and columns with clashing names."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

SOURCE = Path("/root/testdata/sf0.001")
CLASHING = "_group _at _key _leaf _rows _date _n _b _row _version _hash _first _last _was _side _digest key key_ a b id_ record entry side pass_ at_ node root cls location name core names ids addresses keys pattern run series at rec dia values target found wanted n_tokens piece rank restored layers lost n_words street form start end value field".split()


def made(folder: Path, mode: str) -> str:
    """The tables in a folder, in the given mode: nulls, empty or twice."""
    random = np.random.default_rng(1)
    for source in SOURCE.glob("*.parquet"):
        table = pq.read_table(source)
        if mode == "empty":
            table = table.slice(0, 0)
        if mode == "twice":
            table = pa.concat_tables([table, table])
        columns = {}
        for name in table.column_names:
            column = table.column(name).combine_chunks()
            if mode == "nulls":
                lost = random.random(table.num_rows) < 0.12
                column = pa.array([None if x else v for x, v in zip(lost, column.to_pylist(), strict=True)], column.type)
            columns[name] = column
        for name in CLASHING:
            columns.setdefault(name, pa.array(["clash"] * table.num_rows, pa.string()))
        pq.write_table(pa.table(columns), folder / source.name)
    return str(folder)
