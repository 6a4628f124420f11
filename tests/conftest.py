import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from oracle_check import make_session
    return make_session()


def ring(*points):
    return [(float(x), float(y)) for x, y in points]


SQUARE = [[ring((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]]
RIGHT = [[ring((1, 0), (2, 0), (2, 1), (1, 1), (1, 0))]]
ELL = [[ring((0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0))]]
DONUT = [[ring((0, 0), (3, 0), (3, 3), (0, 3), (0, 0)), ring((1, 1), (1, 2), (2, 2), (2, 1), (1, 1))]]
BOW = [[ring((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))]]
NESTED = [[ring((0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75), (0.25, 0.25))]]
AWAY = [[ring((9, 9), (10, 9), (10, 10), (9, 10), (9, 9))]]
CORNER = [[ring((1, 1), (2, 1), (2, 2), (1, 2), (1, 1))]]
SHIFTED = [[ring((0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5), (0.5, 0.5))]]
HALF_ON = [[ring((0, 0.5), (1, 0.5), (1, 1.5), (0, 1.5), (0, 0.5))]]


def frame(spark, rows, ids="id string"):
    from boundaryspark.schema import GEOMETRY_DDL
    return spark.createDataFrame(rows, f"{ids}, geom {GEOMETRY_DDL}")
