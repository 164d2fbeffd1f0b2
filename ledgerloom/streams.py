"""Sorted frames of a partition, as whole groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def whole_groups(frames: Iterator[pd.DataFrame], by: str) -> Iterator[pd.DataFrame]:
    """Frames that end where a group ends, of batches that are sorted by `by`."""
    rest: pd.DataFrame | None = None
    for pdf in frames:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        g = pdf[by].to_numpy()
        last = int(np.searchsorted(g, g[-1], "left"))
        if last:
            yield pdf.iloc[:last]
        rest = pdf.iloc[last:]
    if rest is not None and len(rest):
        yield rest
