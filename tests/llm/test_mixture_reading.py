import numpy as np
import pytest

from harborline.llm import mixture, reading_level
from harborline.session import table

TARGETS = "source string, target_weight double, max_repeats int"


def documents(spark, sizes):
    rows, n = [], 0
    for source, count in sizes.items():
        for k in range(count):
            rows.append((n, f"{source} text {k} " + "word " * (20 + k % 30), source if k % 3 else source.upper().replace("_", "-"), 1))
            n += 1
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, copies int")


def test_shares_and_caps(spark):
    docs = documents(spark, {"big_one": 900, "mid_one": 300, "small": 40, "other": 50})
    targets = spark.createDataFrame([("big_one", 50.0, 1), ("mid-One", 30.0, 2), ("small", 15.0, 8), ("absent", 5.0, 3)], TARGETS)
    got = {r.source: r for r in mixture.shares(docs, targets).collect()}
    assert got["absent"].share == 0 and got["absent"].target_share == 0
    for name, share in (("big_one", 50 / 95), ("mid-One", 30 / 95), ("small", 15 / 95)):
        assert got[name].target_share == pytest.approx(share) and got[name].share == pytest.approx(share, rel=0.03)
        assert got[name].most_repeats <= got[name].max_repeats
    rows = mixture.mixture(docs, targets).collect()
    assert sum(r.n_tokens for r in rows) == sum(r.tokens for r in got.values()) and len({(r.doc_id, r.copy_no) for r in rows}) == len(rows)
    assert [r.doc_id for r in rows] == [r.doc_id for r in mixture.mixture(docs, targets).collect()] != sorted(r.doc_id for r in rows)
    few = {r.source: r for r in mixture.shares(docs, targets, total=5000).collect()}
    assert sum(r.tokens for r in few.values()) == pytest.approx(5000, rel=0.1)


def test_copies_of_a_text_count_as_one(spark):
    docs = spark.createDataFrame([(n, "the same text", s) for n, s in enumerate(["a", "b", "a", None, "A"])] + [(9, None, "a"), (10, "", "a"), (None, "x y", "a"), (11, "own text", "b"), (11, "own text", "b")], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 50.0, 2), ("b", 50.0, 2)], TARGETS)
    rows = mixture.mixture(docs, targets, total=10**6).collect()
    assert sorted((r.doc_id, r.copy_no, r.source) for r in rows) == [(0, 1, "a"), (0, 2, "a"), (11, 1, "b"), (11, 2, "b")]


def test_empty(spark):
    docs = documents(spark, {"a": 3})
    targets = spark.createDataFrame([("a", 1.0, 1), (None, 1.0, 1)], TARGETS)
    assert mixture.mixture(docs.limit(0), targets).count() == mixture.mixture(docs, targets.limit(0)).count() == 0
    assert mixture.shares(docs.limit(0), targets).first().tokens == 0


def test_means_beyond_any_bound(spark):
    docs = documents(spark, {"a": 40, "b": 40})
    targets = spark.createDataFrame([("a", 90.0, 3000), ("b", 10.0, 3000)], TARGETS)
    sized = mixture.measured(docs, targets)
    solved = {r["source"]: r for r in mixture.rates(sized, targets, total=4_000_000)}
    assert solved["a"]["mean"] > 700
    used = {r.source: r.tokens for r in mixture.replicated(sized, list(solved.values())).selectExpr("source", "n_tokens * copies AS t").groupBy("source").sum("t").toDF("source", "tokens").collect()}
    assert used["a"] == pytest.approx(solved["a"]["wanted"], rel=0.03)


def test_poisson_steps():
    assert mixture._cumulative(float("inf"), 3) == [0, 0, 0] and mixture._cumulative(1.0, 2) == pytest.approx([0.36788, 0.73576], abs=1e-4)


# ---- reading level

EASY = "The dog ran to the door. We saw it and put the cup on the bed. "
HARD = "Notwithstanding considerable methodological uncertainty, the retrospective standardization of contractual documentation necessitates comprehensive reconsideration among institutional consignees. "
PLAIN = "When the driver arrives at the loading area, staff should check the label and call the manager before the truck is opened. "


def test_prose_gate():
    prose = reading_level.is_english_prose
    assert prose(EASY * 5) and prose(HARD * 4) and prose("- " + PLAIN.replace(". ", ".\n- ") * 5)
    assert not prose(EASY * 2) and not prose(None) and not prose("") and not prose("CAR-01;SKU-2;5;Kel\n" * 80) and not prose("AX-9 12 77 " * 80)
    assert not prose("Der Fahrer wartet seit 36 Minuten an der Rampe in Yardale und die Ware wird am Tor abgegeben. " * 6)
    assert not prose("Llame a la oficina de Barham si falta un paquete y revise la etiqueta antes de cargar el camión. " * 6)


def test_isotonic():
    x, y = reading_level._isotonic(np.arange(6.0), np.array([0, 1, 0, 1, 1, 1.0]))
    assert y.tolist() == [0, 0, 0.5, 0.5, 1, 1] and x.tolist() == [0, 0, 1, 2, 3, 5]


def test_ranks_and_levels(spark):
    docs = spark.createDataFrame([(3 * n + k, t * (5 + n % 7), "s", "clash") for n in range(30) for k, t in enumerate((EASY, PLAIN, HARD))] + [(500, None, "s", "c"), (501, "short", "s", "c"), (None, EASY * 9, "s", "c"), (502, HARD * 20_000, "s", "c")], "doc_id bigint, text string, source string, score string")
    labels = spark.createDataFrame([(n, "r", reading_level.BANDS[n % 3]) for n in range(45)] + [(0, "r", "basic"), (0, "q", "basic"), (1, "q", "advanced"), (2, None, None)], "doc_id bigint, rater string, reading_band string")
    ranker = reading_level.fitted(docs, labels)
    got = {r.doc_id: r.reading_band for r in reading_level.levels(docs, ranker).collect()}
    assert {n: got[n] for n in range(90)} == {n: reading_level.BANDS[n % 3] for n in range(90)} and got[502] == "advanced" and not {500, 501} & set(got)
    assert reading_level.fitted(docs, labels.limit(0)) is None and reading_level.levels(docs, None).where("reading_band IS NOT NULL").count() == 0
    assert reading_level.levels(docs.limit(0), ranker).count() == 0
    assert reading_level.profile(docs, ranker).count() == 3


def test_held_out_accuracy(spark):
    """On the given judgements, with documents of one clear band; every fifth held out."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "reading_labels")
    rows = reading_level.featured(docs).join(reading_level.judged(labels), "doc_id").orderBy("doc_id").collect()
    x, y = np.array([r.x for r in rows]), np.array([reading_level.BANDS.index(r.band) for r in rows])
    out = np.arange(len(y)) % 5 == 0
    ranker = reading_level.fit(x[~out], y[~out])
    assert (ranker.levels(x[out]) == y[out]).mean() > 0.9  # some judgements are wrong
