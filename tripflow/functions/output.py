"""Output normalisation for engine-to-engine comparison.

Averages and sums of doubles differ between engines (and between partition
layouts) in the last bits, because floating-point addition depends on the
order of the terms. The registered queries therefore round every double
column at the very end in two steps: to 9 places first, which removes that
noise, then to 4 places. A one-step rounding would send a mean that sits
exactly on a 4-place tie (732.45 / 8 = 91.55625) up or down depending on the
noise. The operators themselves never round for this purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

PLACES = 4
NOISE_PLACES = 9


def round_doubles(df: DataFrame, places: int = PLACES) -> DataFrame:
    cols = [
        F.round(F.round(F.col(f.name), NOISE_PLACES), places).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)
