"""Statistics-program files in chunks, on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pandas.io.stata import StataReader


def chunks(path: str, size: int = 5_000, expect_rows: int | None = None) -> Iterator[pd.DataFrame]:
    """Frames of at most ``size`` rows; raises in the end if the number of rows is another than expected."""
    seen = 0
    with StataReader(path, convert_categoricals=False) as reader:
        while True:
            try:
                frame = reader.read(size)
            except StopIteration:
                break
            if not len(frame):
                break
            seen += len(frame)
            yield frame
    if expect_rows is not None and seen != expect_rows:
        raise ValueError(f"{path} has {seen} rows, not {expect_rows}")


def labels(path: str) -> tuple[dict[str, str], dict[str, dict[int, str]]]:
    """(variable labels, value labels)."""
    with StataReader(path, convert_categoricals=False) as reader:
        return reader.variable_labels(), reader.value_labels()
