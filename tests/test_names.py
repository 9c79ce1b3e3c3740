"""Dictionary join (C1) and fuzzy best match (C7) against brute force."""
import random

from pyspark.sql import functions as F

from groundwork.operators import names


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_reference_examples(spark):
    d = spark.createDataFrame([("BROOKFIELD HOMES", " BROOKFIELD HOMES", 0.95), ("ASHTON HOMES", "ASHTON HOMES", 1.0)],
                              "original_name string, corrected_name string, confidence_score double")
    df = spark.createDataFrame([(1, "BROOKFIELD HOMES"), (2, "BROKFIELD HOMES"), (3, "N/A"), (4, ""), (5, None),
                                (6, "brookfield homes"), (7, "Totally Other")], "i int, b string")
    out = {r.i: r.b for r in names.fuzzy_match(df, "b", d).collect()}
    assert out[1] == " BROOKFIELD HOMES"
    assert "BROOKFIELD" in out[2].upper()
    assert out[3] == out[4] == out[5] == "N/A"
    assert out[6].upper() == out[1].upper()
    assert out[7] == "Totally Other"


def test_candidates_exact_against_brute_force(spark):
    rng = random.Random(3)
    alphabet = "ABCD "
    dict_names = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))).strip() or "A"
                         for _ in range(120)})
    probe = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))).strip() or "B"
                    for _ in range(150)})
    dk = spark.createDataFrame([(x,) for x in dict_names], "_dkey string")
    nk = spark.createDataFrame([(x,) for x in probe], "_nkey string")
    for d in (1, 2):
        got = {(r._nkey, r._dkey, r.dist) for r in names.fuzzy_candidates(nk, dk, d).collect()}
        want = {(a, b, lev(a, b)) for a in probe for b in dict_names if lev(a, b) <= d}
        assert got == want


def test_apply_dictionary(spark):
    d = spark.createDataFrame([("  Builder 1 ", "GROUP 0", 0.9)], "original_name string, corrected_name string, confidence_score double")
    df = spark.createDataFrame([("builder 1",), ("Builder 2",)], "n string")
    out = {r.n: (r.name_corrected, r.match_confidence) for r in names.apply_dictionary(df, "n", d).collect()}
    assert out == {"builder 1": ("GROUP 0", 0.9), "Builder 2": ("Builder 2", 1.0)}
