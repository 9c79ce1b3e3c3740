import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from groundwork.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="groundwork-tests")
    yield s


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


# Numbers and values of an extraction answer; fields without a value are N/A, one number comes twice.
ANSWER = {
    1: ("WO NO.", "77-031"), 2: ("Builder Name", "NORTHGATE LIVING"), 3: ("Project Name", "ELM HOLLOW"), 4: ("Month", "OCTOBER"),
    5: ("Year", "21"), 6: ("Company", "AE3 Excavating"), 7: ("Description", "spread topsoil behind lots 4 to 9"),
    8: ("Service1", "SKID STEER"), 9: ("D1", "3"), 10: ("Q1", "X1"), 11: ("H1", "6.5"), 12: ("D2", "4"), 13: ("Q2", "X1"), 14: ("H2", "8"),
    15: ("Service2", "DUMP TRAILER"), 16: ("D3", "3"), 17: ("Q3", "X2"), 18: ("H3", "12"),
}


@pytest.fixture
def sample_answer():
    lines = ["02. Builder Name: FIRST READING"]
    for n in range(1, 36):
        place = n - 8
        name = f"Service{place // 7 + 1}" if n >= 8 and place % 7 == 0 else f"{'DQH'[(place % 7 - 1) % 3]}{place // 7 * 2 + (place % 7 + 2) // 3}"
        label, value = ANSWER.get(n, (name, "N/A"))
        lines.append(f"{n:02d}. {label}: {value}")
    return "\n".join(lines)


def one_col(spark, values, expr, dtype="string"):
    """Apply a Column function to a single-column DataFrame of values, in order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v")).alias("o"), "i").orderBy("i").collect()]
