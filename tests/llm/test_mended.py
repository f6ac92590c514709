"""Complete alignments, parses with sources, successors of any ids, strict JSON, clashing names."""

import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import chat, fingerprints, jaccard, lines, substrings
from tallyhouse.llm.common import row_key
from tests.llm import cases


def aligned_with_any(texts):
    """Texts without the lines of blocks aligned with any earlier text, of all pairs; an equal text keeps none."""
    split = [t.split("\n") if t else [] for t in texts]
    codes = {}
    number = lambda x: 0 if not x.strip() else codes.setdefault(x, len(codes) + 1)
    coded = [[number(x) for x in s] for s in split]
    out = []
    for i, b in enumerate(coded):
        gone = set()
        for a in coded[:i]:
            if set(a) & set(b) - {0}:
                gone |= set(lines.common_lines(a, b))
            if a == b and any(b):
                gone = set(range(len(b)))
        out.append("\n".join(x for k, x in enumerate(split[i]) if k not in gone))
    return out


def without(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [r.text for r in lines.remove_common_lines(df, **options).orderBy("doc_id").collect()]


@pytest.mark.parametrize("rare", [lines.RARE, None])
def test_line_dedup_equals_alignment_with_every_document(spark, rare):
    assert without(spark, ["X\nY", "Y\nX", "X\nY"], rare=rare) == aligned_with_any(["X\nY", "Y\nX", "X\nY"])
    rng = random.Random(8)
    texts = []
    for group in range(25):
        alphabet = [f"{group} {c}" for c in "abcdefgh"] + [""]
        for _ in range(rng.randint(2, 7)):
            part = [rng.choice(alphabet) for _ in range(rng.randint(1, 8))]
            texts.append("\n".join(part))
            if rng.random() < 0.4:
                texts.append("\n".join(rng.sample(part, len(part))))
    rng.shuffle(texts)
    expected = aligned_with_any(texts)
    assert without(spark, texts, rare=rare) == expected
    assert expected != texts


def test_the_exact_mode_has_no_limit(spark):
    heading = "A common heading of seventy-eight characters, which is less than one hundred"
    for n in (16, 20, 60):
        texts = ["\n".join([heading, f"own {i}", f"more {i}"]) for i in range(n)]
        found = without(spark, texts, rare=None)
        assert found == aligned_with_any(texts) and sum(heading in t for t in found) == 1


def test_factors_are_places_of_the_same_words(spark):
    texts = [t for t in cases.odd_texts()] + [cases.edited(cases.prose(71, 120), i, i % 3) for i in range(9)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = row_key(df, substrings.KEY)
    words = {r[0]: (r[1] or "").encode().split() for r in keyed.select(substrings.KEY, "text").collect()}
    held = 0
    for block in (substrings.BLOCK, 3):
        for r in substrings.factors(keyed, block=block).where("hash is null").collect():
            own = words[r[substrings.KEY]][r.start : r.end]
            assert r.end - r.start >= 35 and len(own) == r.end - r.start
            there = words[r.source][r.source_start : r.source_start + len(own)]
            assert own == there
            assert (r[substrings.KEY], r.start) != (r.source, r.source_start) or df.count() > len(words)
            held += 1
    assert held > 20


def test_longest_matches_equal_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(40):
        sizes = rng.integers(1, 9, 12)
        symbols = rng.integers(0, 3, sizes.sum())
        run = np.repeat(np.arange(12), sizes)
        block = run // 4
        ends = np.cumsum(sizes)
        left = ends[run] - np.arange(len(run))
        length, source = substrings.longest_matches(symbols, block, left)
        text = lambda p, n: tuple(symbols[p : p + n])
        for p in range(len(run)):
            best = 0
            for q in range(len(run)):
                if q != p and block[q] == block[p]:
                    n = 0
                    while n < min(left[p], left[q]) and symbols[p + n] == symbols[q + n]:
                        n += 1
                    best = max(best, n)
            assert length[p] == best
            if best:
                q = source[p]
                assert q != p and block[q] == block[p] and text(q, best) == text(p, best) and left[q] >= best
        begin = substrings.parse(length, ends - sizes, ends)
        covered = np.zeros(len(run), bool)
        for p in begin:
            covered[p : p + length[p]] = True
        assert (covered == (length > 0)).all()


@pytest.mark.parametrize("rows", [1, 3, 1 << 18])
def test_successors_of_far_and_repeated_ids(spark, rows):
    low, high = -(2**63), 2**63 - 1
    docs = [(low, "a"), (high, "z"), (0, "m"), (1, "n"), (2**62 + 5, "p"), (-(2**62), "b"), (None, "0"), (7, None)]
    docs += [(7, "q"), (7, "q"), (7, "q"), (7, "r")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(1))
    found = fingerprints.with_next(fingerprints.fingerprints(df), rows=rows).collect()
    order = sorted(
        ((i, t or "") for i, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1])
    )
    expected = Counter((a[1], b[1]) for a, b in zip(order, order[1:] + order[:1], strict=True))
    assert Counter((r.text, r.next.text) for r in found) == expected


def test_one_id_many_times(spark):
    df = spark.range(10_000).selectExpr("5L AS doc_id", "concat('text ', lpad(id, 5, '0')) AS text")
    found = fingerprints.with_next(fingerprints.fingerprints(df), rows=500).collect()
    following = {r.text: r.next.text for r in found}
    assert len(following) == 10_000
    assert all(following[f"text {i:05}"] == f"text {(i + 1) % 10_000:05}" for i in range(10_000))


def test_json_of_odd_numbers_is_strict():
    def refuse(constant):
        raise AssertionError(constant)

    given = ["1e400", "-1e999", "NaN", "Infinity", "1.0", "1e2", "-0.0", "1e16", "0.5", "12345678901234567890", "1.7976931348623157e308"]
    for text in given:
        line, _, _, wrong = chat._format(
            "user", None, [{"id": "i", "name": "t", "arguments": '{"a":%s}' % text}], None, {"t": {}}
        )
        value = json.loads(line, parse_constant=refuse)["calls"][0]["arguments"]
        if text in ("1e400", "-1e999", "NaN", "Infinity"):
            assert wrong == ["arguments are not JSON"] and isinstance(value, str)
        else:
            assert not wrong and float(value["a"]) == float(text)
    forms = {chat._format("u", None, [{"id": "i", "name": "t", "arguments": a}], None, {"t": {}})[0]
             for a in ('{"a":100.00}', '{"a":100.0}', '{"a":1e2}')}
    assert len(forms) == 1


def test_names_that_clash_or_need_quotes(spark):
    texts = [cases.prose(1, 60), cases.prose(1, 60), "own words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for name in ("a.b", "c`d", substrings.KEY, substrings.SPANS, lines.KEY, lines.GONE, "class_id", "kept"):
        df = df.withColumn(name, F.lit(name)) if "`" not in name and "." not in name else df.select(
            "*", F.lit(name).alias(name)
        )
    for found in (
        substrings.remove_repeats(df), lines.remove_common_lines(df), jaccard.one_per_class(df),
    ):
        assert found.columns[: len(df.columns)] == df.columns
        for r in found.collect():
            assert [r[c] for c in df.columns[2:]] == df.columns[2:]


def _shuffled_bytes(df) -> int:
    """Bytes that the exchanges of ``df``'s last run wrote, as their dataSize metrics say."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name == "ShuffleExchangeExec":
            return node.metrics().get("dataSize").get().value() + walk(node.child())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        children = node.children()
        return sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_next_documents_shuffle_texts_once(spark, tmp_path):
    made = spark.range(3000).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 400) AS text")
    made.repartition(4).write.parquet(str(tmp_path / "texts"))
    texts = spark.read.parquet(str(tmp_path / "texts"))
    found = fingerprints.with_next(fingerprints.fingerprints(texts))
    assert found.count() == 3000
    pairs = found.select("doc_id", "next.text")
    rows = pairs.collect()
    assert all(r.text.startswith(f"w{(r.doc_id + 1) % 3000} ") for r in rows)
    size = texts.selectExpr("sum(length(text))").first()[0]
    assert 0 < _shuffled_bytes(pairs) < 1.5 * size
