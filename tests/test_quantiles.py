import random

import numpy as np
import pytest

from tapewright.config import DEFAULTS
from tapewright.operators.quantiles import exact_quantiles

RANKS = [0.0, 0.02, 0.25, 0.5, 0.75, 0.999, 1.0]


def samples(seed=3):
    rng = random.Random(seed)
    rows = [("hot", 7.0)] * 800  # one value for many rows
    rows += [("hot", round(rng.lognormvariate(0, 4), 3)) for _ in range(700)]
    rows += [("cold", rng.gauss(0, 1)) for _ in range(33)]
    rows += [("one", 5.5), (None, 1.0), (None, 4.0), ("cold", None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [DEFAULTS.quantile_rows, 100, 20])
def test_equals_numpy_for_any_piece_size(spark, limit):
    rows = samples()
    settings = DEFAULTS.with_options(quantile_rows=limit)
    df = spark.createDataFrame(rows, "g string, v double")
    made = {r["g"]: r["quantiles"] for r in exact_quantiles(df, ["g"], "v", RANKS, settings).collect()}
    assert set(made) == {"hot", "cold", "one"}
    for group, values in made.items():
        wanted = np.quantile([v for g, v in rows if g == group and v is not None], RANKS)
        assert np.allclose(values, wanted, rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("limit", [DEFAULTS.quantile_rows, 50])
def test_whole_table(spark, limit):
    rows = [(float(i % 97),) for i in range(500)]
    settings = DEFAULTS.with_options(quantile_rows=limit)
    df = spark.createDataFrame(rows, "v double")
    made = exact_quantiles(df, [], "v", [0.5], settings).collect()
    assert len(made) == 1
    assert made[0]["quantiles"] == [float(np.median([r[0] for r in rows]))]
