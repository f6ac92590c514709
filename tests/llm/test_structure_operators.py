"""Conversation repair, cross-tokenizer alignment and HTML extraction."""

import hashlib
import itertools
import os
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import alignment, html, queries, repair
from tallyhouse.llm.common import tokenizer
from tests.llm import cases, web_pages

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
TURNS = "conv_id long, turn long, role string, text string"
PATTERN = re.compile("(s?(ua)+)?")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


# --- conversation repair ----------------------------------------------------------


def faults(rows):
    """First fault of each (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired lines) by one forward pass over all states, insertions relaxed."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    roles = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def close(best):
        for _ in range(3):
            for state, (c, audit, out) in list(best.items()):
                for letter, to in step[state].items():
                    if letter in roles:
                        new = (c + 2, audit + "I", (*out, f"{roles[letter]}:"))
                        if to not in best or new[:2] < best[to][:2]:
                            best[to] = new
        return best

    for (_, role, text), fault in zip(rows, faults(rows), strict=True):
        new = {}

        def offer(state, *value):
            if state not in new or value[:2] < new[state][:2]:
                new[state] = value

        for state, (c, audit, out) in close(best).items():
            offer(state, c + 3, audit + "D", out)
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            for letter, to in step[state].items():
                if role[:1] == letter:
                    offer(to, c + more, audit + "K", (*out, f"{role}:{text}"))
                if letter in roles:
                    offer(to, c + 2 + more, audit + "R", (*out, f"{roles[letter]}:{text}"))
        best = new
    best = close(best)
    return min((v for k, v in best.items() if k in ("", "a")), key=lambda v: v[:2])


def plain_repair(turns, copies=None):
    """{conv_id: row} by brute force; ``turns`` are (conv_id, turn, role, text, copies)."""
    of = defaultdict(list)
    for conv, turn, role, text, n in turns:
        of[conv] += [(turn, " " if role is None else role, " " if text is None else text)] * n
    out = {}
    for conv, rows in of.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        kinds = Counter(faults(rows))
        known = [t for t, *_ in rows if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
        cost, audit, lines = cheapest(rows)
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            kinds["blank"], kinds["duplicate"], kinds["truncated"],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(lines)),
        )
    return out


def collected(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def random_turns(rng, conv, n):
    roles = ["user", "assistant", "system", "tool", "unsure", "", None]
    texts = ["One.", "Two!", "three", "four. ", " \t", "", None, "five?\n", "six"]
    out = []
    for i in range(n):
        turn = rng.choice([i, i, i, i + 1, None, max(0, i - 1), i * 3])
        role = rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0]
        out.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}.", 1))
    return out


def test_repair_equals_a_forward_search(spark):
    rng = random.Random(3)
    turns = [t for c in range(150) for t in random_turns(rng, c if c else None, rng.randint(1, 12))]
    turns += [(1000, i, "user" if i % 2 == 0 else "assistant", f"line {i}.", 1) for i in range(1500)]
    turns += [(1001, 0, "user", "same", 1)] * 60 + [(1002, None, None, None, 1)]
    turns += random_turns(rng, 1003, 900) + [(1004, 5, "user", "gone", 0)]
    df = spark.createDataFrame(turns, f"{TURNS}, copies int").withColumn("group", F.lit(1))
    expected = plain_repair(turns)
    assert collected(repair.repair(df.repartition(5), copies="copies")) == expected


def test_repair_over_all_edit_sequences():
    """The least (cost, audit) of tiny conversations by listing every audit."""
    step, roles = repair.STEP, "sua"
    for kinds in itertools.product(range(0, 16, 1), repeat=2):
        found = repair.least(
            repair.span_cells(np.array(kinds), np.zeros(2, np.int64), 1)[0]
        )
        best = None
        letters = ["".join(x) for x in itertools.product(["", "I", "II"], "KRD", ["", "I", "II"], "KRD", ["", "I", "II"])]
        for audit in letters:
            state, cost, row = 0, 0, 0
            for edit in audit:
                role = repair._next_role(state)[0]
                if edit == "I":
                    cost, state = cost + 2, step[state, role]
                    continue
                initial, gone, cut = "sua?"[kinds[row] // 4], kinds[row] // 2 % 2, kinds[row] % 2
                row += 1
                if edit == "D":
                    cost += 3
                    continue
                letter = initial if edit == "K" else role
                if gone or (state, letter) not in step:
                    break
                cost += cut + (2 if edit == "R" else 0)
                state = step[state, letter]
            else:
                if state in repair.FINAL and (best is None or (cost, audit) < best):
                    best = cost, audit
        assert found == (best[0], best[1].encode()), (kinds, roles)


def test_a_conversation_over_many_ranges(spark):
    rng = random.Random(5)
    turns = random_turns(rng, 7, 4000) + random_turns(rng, 8, 3) + random_turns(rng, 6, 3)
    df = spark.createDataFrame(turns, f"{TURNS}, copies int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = collected(repair.repair(df, copies="copies"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == plain_repair(turns)


def test_repair_query(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    turns = []
    for r in rows:
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", r.text) if fault == 2 else r.text
        role = "user" if fault == 4 else r.role
        turns.append((r.conv_id, r.turn, role, text, 0 if fault == 0 else 2 if fault == 3 else 1))
    found = collected(queries.op11_repair(spark, SF))
    assert found == plain_repair(turns)
    assert {r.conv_id for r in rows} == set(found)


def test_nothing_to_repair(spark):
    assert repair.repair(spark.createDataFrame([], TURNS)).count() == 0


# --- cross-tokenizer alignment ------------------------------------------------------


def plain_alignment(docs):
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    signs = {s: bytes([i]) for i, s in enumerate(alignment.bpe.byte_characters())}
    spell_a = lambda i: b"".join(signs[c] for c in a.id_to_token(i))

    def spell_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    found = []
    for _, text in docs:
        whole = (" " + (text or "")).encode()
        one = [(i, spell_a(i)) for i in a.encode(" " + (text or ""), add_special_tokens=False).ids]
        two = [(i, spell_b(i)) for i in b.encode(text or "")]
        if not text or b"".join(x for _, x in one) != whole or b"".join(x for _, x in two) != whole:
            found.append(([], [], []))
            continue
        ends = [set(itertools.accumulate(len(x) for _, x in side)) for side in (one, two)]
        cuts = sorted(ends[0] & ends[1])
        groups = [([], []) for _ in cuts]
        for k, side in enumerate((one, two)):
            at = 0
            for i, x in side:
                at += len(x)
                groups[bisect_left(cuts, at)][k].append(i)
        found.append((one, two, groups))
    holding = Counter()
    for _, _, groups in found:
        holding.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    top = defaultdict(int)
    for (x, _), n in holding.items():
        top[x] = max(top[x], n)
    out = []
    for (doc_id, _), (one, two, groups) in zip(docs, found, strict=True):
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((
            doc_id, len(one), len(two), len(groups), len(links),
            sum(holding[x] == top[x[0]] for x in links), sum(holding[x] for x in links), text,
        ))
    return out


def strange_texts():
    rng = random.Random(11)
    signs = [*"ab '\n\tst.é1 日▁<>|0x", "  ", "<s>", "<|endoftext|>", "<0x41>", "tion", "🙂"]
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    return [*out, " " * 300, "é" * 200, "日本" * 100 + "x", "=" * 500, "<unk></s>", " a", "a ", "a\x00b"]


def test_alignment_equals_sets_of_ends(spark):
    texts = cases.odd_texts() + strange_texts() + cases.odd_texts()[:12]
    docs = [(None if i == 3 else i // 2, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("slice", "code", "documents", "groups"):
        df = df.withColumn(name, F.lit("x"))
    found = alignment.linked(
        df.repartition(3), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    )
    expected = plain_alignment(docs)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert any(r[1] == 0 and r[0] is not None for r in expected)


@pytest.mark.parametrize("lane", [1, 3, 50, 10**6])
def test_lanes_give_the_same_groups(lane):
    rng = np.random.default_rng(lane)
    firsts, ends, at = [[0], [0]], [[], []], 0
    for _ in range(40):
        size = int(rng.integers(0, 60))
        for k in range(2):
            inner = np.sort(rng.choice(np.arange(1, size), size // 3, replace=False)) if size > 2 else []
            own = [*inner, size] if size else []
            ends[k] += [at + int(e) for e in own]
            firsts[k].append(firsts[k][-1] + len(own))
        at += size
    args = [np.array(x, np.int64) for x in (ends[0], firsts[0], ends[1], firsts[1])]
    low, high, b_low, b_high = alignment.merge(*args, lane=lane)
    common = sorted(set(ends[0]) & set(ends[1]))
    assert args[0][high - 1].tolist() == args[2][b_high - 1].tolist() == common
    assert low.tolist() == [0, *high[:-1]] and b_low.tolist() == [0, *b_high[:-1]]


def test_wide_groups_are_counted_by_distinct_ids():
    a, b = np.array([1, 1, 2, 3]), np.array([7, 8, 7])
    groups = tuple(np.array(x) for x in ([0, 3], [3, 4], [0, 2], [2, 3]))
    document = np.array([0, 0])
    tables = []
    for wide in (0, 100):
        total = Counter()
        for row in zip(*alignment.links(a, b, groups, document, wide), strict=True):
            total[row[:3]] += row[3]
        tables.append(total)
    assert tables[0] == tables[1] and sum(tables[0].values()) == 7


def test_alignment_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    expected = plain_alignment([(r.doc_id, r.text) for r in rows])
    found = queries.op12_alignment(spark, SF).collect()
    expected = [(*r[:7], sha(r[7]) if r[7] else "") for r in expected]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_nothing_to_align(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    paths = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    assert alignment.linked(none, *paths).count() == 0
    assert alignment.align(pa.array([None, ""]), *paths)[1].tolist() == [0, 0, 0]


# --- HTML extraction ------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return html.train(spark.read.parquet(f"{SF}/pages.parquet"))


def article(page):
    """Blocks of the article element of a sample page, by regular expressions."""
    import html as entities

    inner = re.search("<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split("</?(?:p|h1)>", re.sub("<(?:br|/?b)>", " ", inner))
    blocks = [" ".join(entities.unescape(b).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_html_query_returns_the_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = {r.page_id: r for r in queries.op13_html(spark, SF).collect()}
    assert len(found) == len(pages)
    for page in pages:
        row = found[page.page_id]
        assert (row.url, row.text, row.n_chars) == (page.url, article(page.html), len(article(page.html)))


@pytest.mark.parametrize("name", web_pages.PAGES)
def test_pages_of_unseen_layouts(model, name):
    assert html.main_texts([web_pages.PAGES[name][0]], model) == [web_pages.wanted(name)]


def test_held_out_nodes(spark):
    """Scores of nodes of pages that were not trained on, re-dressed and as they are."""
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]
    fitted = html.boost(*html.examples(pages[:30]))
    x, y = html.examples(pages[30:])
    assert ((fitted.score(x) > 0) == y).mean() > 0.97


def plain_boost(x, y, rounds):
    """Trees of the same kind, grown by trying every cut of every feature; log-odds of the rows."""
    share = (y.sum() + 1) / (len(y) + 20)
    score = np.full(len(y), np.log(share / (1 - share)))

    def grow(rows, depth, g, h):
        if depth == 0:
            return [(rows, -html.RATE * g[rows].sum() / (h[rows].sum() + 1))]
        best = (1e-6, None)
        for j in range(x.shape[1]):
            for cut in np.unique(np.quantile(x[:, j], np.linspace(0, 1, html.BINS + 1)[1:-1])):
                left = x[rows, j] <= cut
                a, b = rows[left], rows[~left]
                if h[a].sum() < 1 or h[b].sum() < 1:
                    continue
                gain = sum(g[i].sum() ** 2 / (h[i].sum() + 1) for i in (a, b))
                gain -= g[rows].sum() ** 2 / (h[rows].sum() + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, (a, b))
        if best[1] is None:
            return grow(rows, 0, g, h)
        return [leaf for side in best[1] for leaf in grow(side, depth - 1, g, h)]

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        for rows, value in grow(np.arange(len(y)), html.DEPTH, p - y, p * (1 - p)):
            score[rows] += value
    return score


def test_boosting_equals_a_plain_version():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4)).astype(np.float32)
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    found = html.boost(x, y, rounds=4).score(x)
    assert np.allclose(found, plain_boost(x, y, 4))


def test_decoding_keeps_the_best_closed_set():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = 9
        parent = np.array([-1, *[int(rng.integers(0, i)) for i in range(1, n)]])
        depth = [0] * n
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        levels = [np.flatnonzero(np.array(depth) == d) for d in range(max(depth) + 1)]
        score = rng.normal(size=n)
        kept = html.decode(score, np.zeros(n, bool), parent, levels)
        closed = [
            s for s in itertools.product([0, 1], repeat=n)
            if all(not s[i] or parent[i] < 0 or s[parent[i]] for i in range(n))
        ]
        assert np.isclose(score[kept].sum(), max(np.dot(s, score) for s in closed))
        assert all(parent[i] < 0 or kept[parent[i]] for i in np.flatnonzero(kept))


def test_odd_pages(spark, model):
    odd = [None, "", "<", "a < b <", '<p "unclosed>text</p><p>more', "<div>" * 3000 + "x", "</p></div></nope>", "<!-- open",
           "<script>never closed", "&#0;&#x110000;&nosuch;&amp", "<p>" * 500, "\x00퟿"]
    pages = [(i, "u", t, "clash") for i, t in enumerate(odd)] + [(1, "u", "", "clash"), (None, None, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    df = df.withColumn("a.b", F.lit(1))
    rows = html.extract(df, model).collect()
    assert len(rows) == len(pages) and all(r.text is not None for r in rows)
    assert [r.text for r in rows if not (r.html or "").strip("<\x00")] == [""] * 5
    assert html.extract(df.limit(0), model).count() == 0
    none = html.train(df.limit(0))
    assert html.main_texts(["<article><p>Some text."], none) == [""]


def test_a_long_page_is_read_whole(model):
    body = "".join(f"<p>Sentence {i}, of a long story about the harbour.</p>" for i in range(30_000))
    page = f"<nav><a href=/x>Home</a></nav><article>{body}</article><footer>Bye</footer>"
    text = html.main_texts([page], model)[0]
    assert text.count("\n\n") == 29_999 and text.startswith("Sentence 0,") and text.endswith("harbour.")
