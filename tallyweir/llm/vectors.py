"""What the operators on vectors share: which rows take part, and vectors as arrays of doubles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

#: Vectors that indexes are fitted on, for each number of dimensions.
SAMPLE = 16_384


def usable(embedding: str = "embedding") -> Column:
    """Not null, not empty, not zero, and only finite components."""
    return F.expr(
        f"coalesce(size({embedding}) > 0 AND forall({embedding}, x -> x IS NOT NULL AND abs(x) < double('infinity'))"
        f" AND exists({embedding}, x -> x <> 0), false)"
    )


def matrix(embeddings: pd.Series) -> np.ndarray:
    return np.stack(embeddings.to_list()).astype(np.float64) if len(embeddings) else np.empty((0, 0))


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def sampled(share: float, *columns: str) -> Column:
    """A share of the rows, chosen by a hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1_000_000_007)) < F.lit(int(share * 1_000_000_007))
