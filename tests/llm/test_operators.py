"""Each training-data operator against brute force, with nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from groundwork.llm import html_extract, url_filter
from groundwork.llm.components import components
from groundwork.llm.decontaminate import consistent, find_leaks
from groundwork.llm.embedding_dedup import dedup_embeddings
from groundwork.llm.html_extract import extract_pages
from groundwork.llm.language_id import identify, learn
from groundwork.llm.line_dedup import dedup_lines, with_chunks
from groundwork.llm.minhash_dedup import near_duplicates
from groundwork.llm.packing import fullest, pack, plan_bins
from groundwork.llm.substring_dedup import dedup_substrings, first_windows
from groundwork.llm.token_counts import count_tokens

RNG = random.Random(5)
SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe".split()


def words(n, rng=RNG):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def corpus():
    """(doc_id, text) with copies, near copies, shared passages, odd characters, nulls and empty texts."""
    base = [" ".join(words(RNG.randint(3, 120))) for _ in range(25)]
    passage, lines = " ".join(words(60)), ["\n".join(" ".join(words(6)) for _ in range(8)) for _ in range(3)]
    texts = base + base[:5] + [base[3]] * 4 + [None, "", " \n\t", "one", "One two", "one TWO"]
    texts += [f"{x} {passage} {y}" for x, y in zip(base[5:10], base[10:15])] + [f"{x}\n{lines[0]}\n{y}" for x, y in zip(base[:4], base[4:8])]
    for t in base[15:20]:
        own = t.split()
        own[len(own) // 2] = "changed"
        texts.append(" ".join(own))
    texts += ["é ñ ß İ \u2003x  y \x1c z <|endoftext|> don't 12.5km", "a" * 700, "ab" * 400, " ".join(words(9000))]
    RNG.shuffle(texts)
    return list(enumerate(texts))


DOCS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    """Input with columns whose names clash with the operators' own."""
    rows = [(i, t, "c0", i) for i, t in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, places string, n long").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_packing(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = pack(docs, path).collect()
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in DOCS}
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert r.start == r.piece * 2048 and r.length == min(2048, len(ids[r.doc_id]) - r.start)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) == math.ceil(sum(r.length for r in rows) / 2048)
    assert pack(none, path).count() == 0


def test_fullest_is_the_best_subset():
    for _ in range(60):
        counts = [0] + [RNG.choice([0, 0, 1, 3]) for _ in range(12)]
        room = RNG.randint(0, 30)
        sums = {0}
        for length, n in enumerate(counts):
            sums = {s + k * length for s in sums for k in range(n + 1)}
        chosen = fullest(counts, room)
        assert all(k <= counts[length] for length, k in chosen)
        assert sum(length * k for length, k in chosen) == max(s for s in sums if s <= room)
    assert plan_bins({}, 10) == []


def test_urls(spark):
    urls = [None, "", "no host", "http://A.Example.NET/en/x?y#z", "http://net", "http://net/", "ftp://x.net?q/en/", "http://example.com/de/1", "http://my-example.com/de/", "https://q.org/fr/", "http://example.net/de/", "x://h/p://net/", "http://net/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    got = {r.page_id: r for r in url_filter.filter_urls(pages, url_filter.RULES).collect()}
    blocks = {r.page_id: r for r in url_filter.filter_urls(pages, url_filter.RULES, most_index_bytes=1).collect()}
    assert got == blocks
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)


def test_colliding_digests_are_told_apart():
    index = url_filter.DigestIndex(url_filter.RULES, digest=lambda s: 7)
    assert url_filter.judge(index, ["a.net", "org", "b.com"], ["/en/", "/fr/x", "/de/"]) == (["net/", "org/fr/", None], ["block", "allow", None])


def test_lines(spark, docs, none):
    out = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert len(out) == len(DOCS) and dedup_lines(none).count() == 0
    texts = dict(DOCS)
    for i, t in DOCS:
        assert out[i].places == "c0"
        if t is None or "\n" not in t:
            assert out[i].text == t and out[i].n_removed == 0
        else:
            assert out[i].n_lines == t.count("\n") + 1
    shared = "\n".join(f"line {k} of the shared part" for k in range(12))
    own = [(1, f"a b c\n{shared}\nd e f"), (2, f"new first line\nmore\n{shared}\nlast"), (3, shared), (3, shared)]
    got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(spark.createDataFrame(own, "doc_id long, text string")).collect())
    assert got[0] == (1, own[0][1], 0)
    assert got[1][2] >= 6 and got[1][1].startswith("new first line") and got[2] == got[3] and got[2][2] >= 6
    assert texts


def test_lines_all_repeated_runs(spark):
    rng = random.Random(11)
    texts = ["\n".join(rng.choice(["", " ", "a", "b", "c d", "e", "f", "g"]) for _ in range(rng.randint(1, 9))) for _ in range(150)]
    runs = ["\n".join(" ".join(words(5, rng)) for _ in range(rng.randint(2, 4))) for _ in range(40)]
    texts += [f"{' '.join(words(4, rng))}\n{run}\n{' '.join(words(4, rng))}" for run in runs for _ in range(2)]
    rows = [(None, "a\nb\na\nb\nb"), (3, texts[3]), (3, "x\ny\nx\ny"), *enumerate(texts), (1000, None), (1001, ""), (1002, "z\n" * 20)]
    seen, first = {}, {}
    for i, t in rows:
        own = (t or "").split("\n")
        for at in range(len(own) - 1):
            if any(x.strip() for x in own[at : at + 2]):
                place = (i is not None, i or 0, at)
                first[tuple(own[at : at + 2])] = min(first.get(tuple(own[at : at + 2]), place), place)
    for i, t in rows:
        own = (t or "").split("\n")
        gone = {p for at in range(len(own) - 1) if first.get(tuple(own[at : at + 2]), (i is not None, i or 0, at)) != (i is not None, i or 0, at) for p in (at, at + 1)}
        left = t if not gone else "\n".join(x for p, x in enumerate(own) if p not in gone)
        seen.setdefault(i, []).append((left or "", len(own) if t is not None else 0, len(gone)))
    out = {}
    for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect():
        out.setdefault(r.doc_id, []).append((r.text or "", r.n_lines, r.n_removed))
    assert {i: sorted(x) for i, x in out.items()} == {i: sorted(x) for i, x in seen.items()}


def test_line_chunks_are_content_defined(spark):
    rng = random.Random(5)
    passage = [" ".join(words(4, rng)) for _ in range(60)]
    own = [[" ".join(words(4, rng)) for _ in range(n)] for n in (7, 20, 1, 3)]
    texts = [own[0] + passage + own[1], own[2] + passage + own[3], ["same"] * 30, ["one"], ["one", "two"], []]
    rows = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "id long, text string")
    for size, reach in ((2, 1), (2, 2), (3, 4)):
        found = {r.id: r for r in with_chunks(rows, "text", size, reach).collect()}
        for r in found.values():
            starts = [c.line for c in r.x_chunks]
            n = len(r.x_lines)
            assert starts == sorted(set(starts)) and (starts[:1] == [0] if n >= size else not starts)
            assert all(b - a >= size for a, b in zip(starts, [*starts[1:], n]))
            if starts:
                assert r.x_end == [b for a, b in zip(starts, [*starts[1:], n]) for _ in range(b - a)]
        # the passage is cut alike in both documents but for the chunks at its ends
        a, b = ({(c.line - len(before), c.h) for c in found[i].x_chunks} for i, before in ((0, own[0]), (1, own[2])))
        inside = {x for x in a if 2 * reach + size <= x[0] < len(passage) - 4 * (reach + size)}
        assert inside and inside <= b


def test_substrings(docs, none):
    out = {r.doc_id: r for r in dedup_substrings(docs).collect()}
    split = {r.doc_id: r for r in dedup_substrings(docs, hot=1).collect()}  # every shared anchor goes window by window
    assert out == split and dedup_substrings(none).count() == 0
    seen = set()
    for i, t in DOCS:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            w = raw[k : k + 100]
            if w in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        assert out[i].n_bytes == len(raw) and out[i].n_removed == sum(gone)
        assert out[i].n_spans == len(re.findall(b"\1+", gone)) and out[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_run_index_finds_first_windows():
    for _ in range(30):
        raws = [bytes(RNG.choices(b"ab", k=RNG.randint(6, 40))) for _ in range(4)]
        seen, want = set(), []
        for r in raws:
            want.append([])
            for k in range(len(r) - 5):
                want[-1].append(r[k : k + 6] not in seen)
                seen.add(r[k : k + 6])
        assert [x.tolist() for x in first_windows(raws, 6)] == want


def test_html(spark):
    model = html_extract.trained()
    right = wrong = 0
    for page in html_extract.labelled_pages(60, seed=1234):
        tree = html_extract.parse(page)
        content = model.marginals(tree) >= 0.5
        for node, _, _ in tree.blocks:
            right += bool(tree.label[node]) == content[node]
            wrong += bool(tree.label[node]) != content[node]
    assert wrong <= 0.03 * right
    html = "<html><body><nav><a href=1>Home</a></nav><article><h1>T&amp;x</h1><p>One <b>tw</b>o,\n three.<p>Four five six.<script>x</p></script></article><footer>&copy; me</footer>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", html), (3, "u", html), (4, "u", "<p"), (5, "u", "<div>" * 3000)]
    out = [(r.page_id, r.text, r.n_chars) for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    want = "T&x One two, three. Four five six."
    assert out[:4] == [(1, "", 0), (2, "", 0), (3, want, len(want)), (3, want, len(want))] and len(out) == 6


def test_broken_html():
    """A head without an end tag and unclosed hidden elements lose no text of the body, and stray tags cost no square time."""
    import time

    text = lambda html: " ".join(t for _, t, _ in html_extract.parse(html).blocks)
    assert text("<html><head><title>No</title><meta charset=x><body><p>One.</p>") == "One."
    assert text("<html><head><title>No</title><style>p{}</style><p>One.</p>") == "One."
    assert text("<html><head><title>No</title>One.") == "One."
    assert text("<head><noscript><p>No</p></noscript></head><p>One.") == "One."
    assert text("<body><div><button>No</div><p>One.</p>") == "One."
    assert text("<body><span><button><span>No</span> no</button>One</span> two") == "One two"
    assert text("<body><div><select><option>No<option>No</select>One</div>") == "One"
    began = time.process_time()
    html_extract.parse("<div>" * 8000 + "</b></i>" * 8000)
    assert time.process_time() - began < 5


def test_sum_product_is_exact():
    """Marginals equal those from adding up all labellings."""
    import itertools

    model = html_extract.trained()
    tree = html_extract.parse("<body><div><p>Some text here, really.</p><a href=1>x</a><div class=ad>Buy</div></div><p>y</p></body>")
    rows, n = html_extract.features(tree), len(tree.tag)
    weights = np.zeros((n, 2))
    for labels in itertools.product((0, 1), repeat=n):
        p = 0.0
        for i, y in enumerate(labels):
            p += sum(model.node[f][y, v] for f, v in enumerate(rows[i]))
            p += model.root[y] if model.starts(tree, i) else model.edge[labels[tree.parent[i]], y]
        for i, y in enumerate(labels):
            weights[i, y] += math.exp(p)
    assert np.allclose(model.marginals(tree), weights[:, 1] / weights.sum(1))


def test_phrases():
    """Phrase counts equal a plain parse by substring search, at any place of the cuts."""
    import random

    from groundwork.llm.language_id import Languages

    def plain(sample: str, text: str) -> int:
        n = i = 0
        while i < len(text):
            j = i + 1
            while j < len(text) and text[i : j + 1] in sample:
                j += 1
            n, i = n + 1, j
        return n

    rng = random.Random(5)
    word = lambda letters, n: "".join(rng.choices(letters, k=n))
    samples = (("one", "aaaaaa"), ("two", word("ab", 300)), ("three", word("abc", 200)), ("four", "abc" * 50))
    known = Languages(samples)
    texts = ["", "a", "z", "aba", "abaaba", "abc" * 100, "a" * 70] + [word("abcz", rng.randint(1, 400)) for _ in range(40)] + [word("ab", 300) for _ in range(10)]
    want = [[plain(sample, t) for _, sample in samples] for t in texts]
    for stretch in (1, 3, 16, 256):
        assert known.phrases(texts, stretch)[0].tolist() == want
    assert want[3][0] == 3 and want[4][0] == 5


def test_language(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    samples = learn(docs, "doc_id", "text", "lang", 200, 300)
    out = identify(docs, samples=samples).collect()
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out)
    odd = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, "12 %%", "en"), (None, "the and", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in identify(odd, samples=samples).collect()][:3] == ["und"] * 3
    assert [r.lang_pred for r in identify(odd).collect()] == ["und"] * 4  # nothing to learn from
    assert identify(docs.where("false")).count() == 0


def test_tokens(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    out = {r.doc_id: r for r in count_tokens(docs, path).collect()}
    for i, t in DOCS:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (out[i].n_bytes, out[i].n_tokens, out[i].over_limit) == (len((t or "").encode()), n, n > 1024)
    assert len(out) == len(DOCS) and count_tokens(none, path).count() == 0


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, none, size):
    sets = {}
    for i, t in DOCS:
        own = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        k = min(size, len(own))
        sets[i] = {tuple(own[j : j + k]) for j in range(len(own) - k + 1)} if own else set()
    least = {i: i for i in sets}
    for _ in sets:  # until nothing changes
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    least[i] = min(least[i], least[j])
    # small nodes and no depth to spare: branching, both turns and blocks are all used
    for out in (near_duplicates(docs, shingle=size).collect(), near_duplicates(docs, shingle=size, node=2).collect()):
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == {i: (len(s), least[i], least[i] == i) for i, s in sets.items()}
    assert near_duplicates(none, shingle=size).count() == 0


def test_components(spark):
    edges = [(RNG.randint(0, 60), RNG.randint(0, 60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 160)]
    least = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(70):
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert dict(components(spark.createDataFrame(edges, "a long, b long")).collect()) == least


def test_leaks(spark):
    item = "A farmer named Holt sold 14 sacks of grain for 9 dollars each and then bought 14 new ropes for the barn."
    again = item.replace("14", "37").replace("9", "8").replace("Holt", "Webb")
    crossed = item.replace("14", "37", 1)  # one slot, two values
    plain = " ".join(words(80))
    texts = [None, "", plain, f"{plain}. {item} {plain}", f"{plain} {again} {plain}", f"{plain} {item.upper()}", again + again]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, coverage string")
    bench = spark.createDataFrame([(5, item), (6, None), (7, "too few"), (None, ""), (8, item)], "item_id long, text string")
    for limit in (1 << 20, 1):  # one block, and a block per item
        out = {r[0]: (r.contaminated, r.item_ids) for r in find_leaks(docs, bench, most_index_bytes=limit).toDF("doc_id", "text", "old", "contaminated", "item_ids", "share").collect()}
        assert [out[i][0] for i in range(7)] == [False, False, False, True, True, out[5][0], True]
        assert out[3][1] == [5, 8] and out[4][1] == [5, 8]
    short = " ".join(item.split()[:12])
    alone = spark.createDataFrame([(1, crossed), (2, short)], "doc_id long, text string")
    assert find_leaks(alone, bench.where("false")).where("contaminated").count() == 0
    assert find_leaks(docs.where("false"), bench).count() == 0


def test_leaks_by_runs(spark):
    item = "A farmer named Holt sold 14 sacks of grain for 9 dollars each and then bought 14 new ropes for the barn."
    plain = " ".join(words(20))
    texts = [f"{plain} {item[::-1].replace('41', '51', 1)[::-1]} {plain}", f"{plain} {item.replace('14', '6').replace('9', '6')} {plain}", plain]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert {r.doc_id: r.contaminated for r in find_leaks(docs, bench).collect()} == {0: True, 1: True, 2: False}
    values = [np.array(x, np.uint64) for x in ([100, 1, 200, 1, 1, 300], [0, 14, 0, 14, 14, 0], [0, 14, 0, 14, 15, 0])]
    assert list(consistent(values[0], values[1], values[0], values[2])) == [(0, 4), (4, 6)]


def test_leaks_with_names_and_case(spark):
    short = "Tom has 5 apples. Tom eats 2 of them. Tom buys 4 more. How many apples now?"
    names = "Yesterday Maria gave Peter some plums, Lena gave Otto bread, then Maria and Otto walked home with Lena."
    dense = "Compute 3 + 4 - 5 + 6 - 7 + 8 and then 9 - 2 + 1 before rounding the sum."
    plain = " ".join(words(20))
    texts = [short.replace("Tom", "Ann"), names.lower(), names.upper(), dense.replace("4", "6"), plain]
    docs = spark.createDataFrame([(i, f"{plain}. {t} {plain}") for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(0, short), (1, names), (3, dense)], "item_id long, text string")
    assert {r.doc_id: r.item_ids for r in find_leaks(docs, bench).collect()} == {0: [0], 1: [1], 2: [1], 3: [3], 4: []}


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=20).tolist(), i % 2) for i in range(60)]
    rows += [(100 + i, (np.array(rows[i][1]) + rng.normal(scale=0.05, size=20)).tolist(), i % 2) for i in range(40)]
    rows += [(200 + i, rows[7][1], 1) for i in range(30)]
    rows += [(300, None, 1), (301, [0.0] * 20, 1), (302, [math.nan] * 20, 1), (303, [None] * 20, 1), (304, rows[7][1], None), (305, rows[7][1][:10], 1), (306, [], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n", F.lit(1))
    ok = {i: np.array(v) / np.linalg.norm(v) for i, v, y in rows if y is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: y for i, _, y in rows}
    links = {i: [j for j in ok if i in ok and j != i and label[i] == label[j] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.98] for i in label}
    least = {i: i for i in label}
    for _ in range(20):
        for i, own in links.items():
            least[i] = min([least[i], *(least[j] for j in own)])
    want = {i: (len(links[i]), least[i], least[i] == i) for i in label}
    for block in (512, 4):  # whole buckets, and buckets cut into many blocks
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in dedup_embeddings(vectors, block=block).collect()} == want
    assert dedup_embeddings(vectors.where("false")).count() == 0


def test_embeddings_of_any_scale_and_label(spark):
    a, near, far = [1.0, 0.0, 0.3], [1.0, 0.01, 0.3], [1.0, 0.6, 0.3]
    rows, want = [], {}
    for k, factor in enumerate((1.0, 1e-170, 1e170, 1e308, 5e-324 * 2**40)):
        rows += [(10 * k + i, [x * factor for x in v], f"scale {k}") for i, v in enumerate((a, near, far))]
        want |= {10 * k: (1, 10 * k), 10 * k + 1: (1, 10 * k), 10 * k + 2: (0, 10 * k + 2)}
    rows += [(100, a, "both"), (101, [x * 4 for x in a], "both"), (102, [x * 1e200 for x in near], "both"), (103, a, "Both")]
    want |= {100: (2, 100), 101: (2, 100), 102: (2, 100), 103: (0, 103)}
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert {r.vec_id: (r.n_links, r.component_id) for r in dedup_embeddings(vectors).collect()} == want
    labels = [(1, a, 1.2), (2, a, 1.5), (3, a, 1.2), (4, a, -0.0), (5, a, 0.0)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in dedup_embeddings(spark.createDataFrame(labels, "vec_id long, embedding array<double>, label double")).collect()}
    assert got == {1: (1, 1), 2: (0, 2), 3: (1, 1), 4: (1, 4), 5: (1, 4)}


def test_pipeline(spark, small_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small_dir}/documents.parquet").withColumn("id", F.lit("x"))
    seen = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, small_dir)
        assert after.columns == docs.columns, name
        docs = spark.createDataFrame(after.collect(), after.schema)
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert kept and set(kept) <= set(seen) and len(kept) < len(seen)
    items = [r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    assert not any(item in t for t in kept.values() for item in items)
    assert max(Counter(t for t in kept.values() if t).values()) == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small_dir)
    assert packed.select("doc_id").distinct().count() == len(kept)


def test_pipeline_stages_keep_clashing_columns(spark, small_dir):
    import corpus_pipeline

    clash = ["lang_pred", "score", "n_lines", "n_removed", "contaminated", "item_ids", "coverage", "kept"]
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").limit(40).select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in clash])
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, small_dir)
        assert after.columns == docs.columns
        rows = after.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in clash), name
        empty = stage(spark, docs.where("false"), small_dir)
        assert empty.columns == docs.columns and empty.count() == 0


def test_pipeline_without_labels(spark, small_dir):
    import corpus_pipeline

    rows = [(1, "some words here", None), (2, None, None), (3, "12 ;", None), (4, "more", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for own in (docs, docs.drop("lang")):
        assert [r.doc_id for r in corpus_pipeline.language(spark, own, small_dir).orderBy("doc_id").collect()] == [1, 4]
