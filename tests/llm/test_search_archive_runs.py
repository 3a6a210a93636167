"""Lexical search, WARC archives and periodic runs against brute force and round trips."""

import base64
import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

ROOT = __file__.rsplit("/tests/", 1)[0]
sys.path.insert(0, ROOT)

EXTRA = "`a.b` string, score string, rank string, file string"
LEAST = -(2**63)


# --- lexical search ---------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def _terms(text):
    return TERM.findall((text or "").translate(UPPER))


def _search(docs, items, k):
    counted = [(d, Counter(_terms(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counted if c)
    total = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    of = defaultdict(set)
    for item, text in items:
        of[item].update(_terms(text))
    out = []
    for item, terms in of.items():
        scores = []
        for doc, c in counted:
            if not c:
                continue
            m = 100 - 90 + (90 * c.total() * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scores.append((-score, LEAST if doc is None else doc))
        out += [(item, rank, None if doc == LEAST else doc, -score)
                for rank, (score, doc) in enumerate(sorted(scores)[:k], 1)]
    return out


def _documents():
    rng = random.Random(3)
    words = ["".join(rng.choice("abÉcß") for _ in range(rng.randint(1, 4))) for _ in range(60)]

    def prose(n):
        return "".join(rng.choice(words) + rng.choice([" ", "-", "\n", "!? ", "\x7f"])
                       for _ in range(n))

    docs = [(i, prose(rng.randint(1, 60))) for i in range(80)]
    same = prose(30)
    docs += [(1000 - i, same) for i in range(40)]  # a class larger than any result
    docs += [(200, " ".join(sorted(_terms(same)))), (201, None), (202, ""), (203, "?! \n"),
             (None, same), (None, prose(5)), (204, prose(4000)), (7, docs[7][1]), (9, prose(3)),
             (205, "x" * 100000), (206, "ABC abc Abc ÉCß éCß")]
    items = [(i, prose(rng.randint(1, 12))) for i in range(12)]
    items += [(20, None), (21, ""), (22, same), (23, "nowhere else"), (3, prose(4)),
              (None, prose(3)), (24, "x" * 100000)]
    return docs, items


@pytest.mark.parametrize("k, limit", [(10, 4 << 20), (2, 300)])
def test_search_matches_brute_force(spark, k, limit):
    from tripledger.llm.op11_lexical_search import search

    docs, items = _documents()
    table = spark.createDataFrame([(d, t, "x", "y", "z", "w") for d, t in docs],
                                  f"doc_id long, text string, {EXTRA}").repartition(5)
    asked = spark.createDataFrame([(i, t, "x", "y", "z", "w") for i, t in items],
                                  f"item_id long, text string, {EXTRA}")
    found = [tuple(r) for r in search(table, asked, k, limit).select(
        "item_id", "rank", "doc_id", "score").collect()]
    assert sorted(found, key=repr) == sorted(_search(docs, items, k), key=repr)


def test_search_of_empty_tables(spark):
    from tripledger.llm.op11_lexical_search import search

    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(docs.where("false"), items).count() == 0
    assert search(docs, items.where("false")).count() == 0
    assert [tuple(r) for r in search(docs, items).select("rank", "doc_id").collect()] == [(1, 1)]


def test_equal_bags_are_one_class(spark):
    from tripledger.llm import op11_lexical_search as op

    docs = spark.createDataFrame([(i, "b a b") for i in range(50, 0, -1)] + [(99, "a b")],
                                 "doc_id long, text string").repartition(7)
    items = op.Items([(1, "a b")])
    rows = op.bags(docs, items)
    n_docs, n_terms, df = op.statistics(rows, 2)
    assert (n_docs, n_terms, df.tolist()) == (51, 152, [51, 51])
    classes = op.bag_classes(rows, n_docs, n_terms, 3).collect()
    assert sorted(r["dids"] for r in classes) == [[1, 2, 3], [99]]


# --- WARC -------------------------------------------------------------------

def _pages():
    rng = random.Random(8)
    body = "<p>é same</p>" * 5
    pages = [(i, f"http://{rng.choice('abc')}.Example.org/p{rng.randint(0, 9)}",
              f"<html>{rng.random()}</html>") for i in range(60)]
    pages += [(100 + i, "https://a.example.org/hot", body) for i in range(60)]
    pages += [(90, "http://user@b.example.org:8080/x?q=1#f", body), (91, None, None), (92, "", ""),
              (93, "no host at all", "x"), (94, "http://c.example.org/\r\nX: y z", "\r\n\r\n"),
              (None, "http://null/", body), (None, "http://null/", "alone"),
              (95, "http://é.org/é", "é" * 50000), (95, "http://é.org/é", "é" * 50000),
              (96, "//c.example.org/" + "k" * 1000, "WARC/1.1\r\n\r\n")]
    return pages


def _expected(pages, least=0):
    firsts = {}
    for page_id, _, html in pages:
        html = html or ""
        if page_id is not None:
            firsts[html] = min(page_id, firsts.get(html, page_id))
    out = []
    for page_id, url, html in pages:
        raw = (html or "").encode()
        first = firsts.get(html or "") if len(raw) >= least else page_id
        kind = "response" if first == page_id or first is None else "revisit"
        out.append((page_id, url or "", kind, first if kind == "revisit" else None, len(raw),
                    base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    raw if kind == "response" else None))
    return out


def _page_table(spark, pages):
    return spark.createDataFrame([(*p, "x", "y", "z", "w") for p in pages],
                                 f"page_id long, url string, html string, {EXTRA}").repartition(4)


@pytest.mark.parametrize("least, lines", [(0, 3000), (6, 3)])
def test_archive_round_trip(spark, least, lines):
    from tripledger.llm import op12_warc as op

    pages = _pages()
    table = _page_table(spark, pages)
    captures = op.write_archive(table, least)
    index = op.build_index(captures, lines)
    back = [tuple(r[c] for c in op._names(op._RECORD)) for r in
            op.fetch(op.lookup(index, table)).collect()]
    back = [(*r[:6], r[6] if r[6] is None else bytes(r[6])) for r in back]
    assert sorted(back, key=repr) == sorted(_expected(pages, least), key=repr)
    assert index.agg({"n": "sum"}).first()[0] == len(pages)

    # One URL: by its key, whatever the scheme; none that is not there.
    asked = spark.createDataFrame([("http://A.example.org/hot",), ("http://a.example.org/ho",),
                                   ("https://a.example.org/hot",), ("zzz://zzz/",)], "url string")
    assert sorted(r["page_id"] for r in op.lookup(index, asked).collect()) == list(range(100, 160))


def test_archive_files_are_gzip_members(spark):
    from tripledger.llm import op12_warc as op

    captures = op.write_archive(_page_table(spark, _pages())).collect()
    files = defaultdict(list)
    for row in captures:
        files[row["file"]].append(row)
    for path, rows in files.items():
        raw, at = open(path, "rb").read(), 0
        for row in sorted(rows, key=lambda r: r["offset"]):
            assert row["offset"] == at
            member = zlib.decompressobj(31)
            record = member.decompress(raw[at:])
            assert member.eof and len(raw) - at - len(member.unused_data) == row["length"]
            assert record.startswith(b"WARC/1.1\r\nWARC-Type: ")
            head = record.split(b"\r\n\r\n")[0]
            assert len([x for x in head.split(b"\r\n") if x.startswith(b"WARC-Target-URI")]) == 1
            at += row["length"]
        assert at == len(raw)


def test_damage_is_noticed():
    from tripledger.llm import op12_warc as op

    record = op.to_record(5, "http://a/", b"payload", None)
    assert op.from_record(record)[0] == 5
    with pytest.raises(ValueError):
        op.from_record(record.replace(b"payload", b"paYload"))
    with pytest.raises(ValueError):
        op.from_record(record[:-1])


def test_url_keys():
    from tripledger.llm.op12_warc import url_key

    assert url_key("http://u:p@A.Example.org:80/x y") == "org:80,example,a)/x%20y"
    assert url_key("plain text") == ")plain%20text"
    assert url_key("") == ")"


def test_archive_of_no_pages(spark):
    from tripledger.llm import op12_warc as op

    table = _page_table(spark, _pages())
    index = op.build_index(op.write_archive(table.where("false")))
    assert op.fetch(op.lookup(index, table)).count() == 0


# --- periodic runs ----------------------------------------------------------

def _runs(words):
    """Every stretch that agrees with itself q words on, smallest q first."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - start >= max(6, 4 * q):
                found.setdefault((start, i - start), q)
            i += 1
    return sorted(((s, length, q) for (s, length), q in found.items()),
                  key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=7),
                          st.integers(1, 7), st.integers(0, 6)), max_size=8))
def test_runs_match_brute_force(parts):
    from tripledger.llm.op13_periodic_runs import find_runs

    words = []
    for unit, times, extra in parts:
        words += unit * times + unit[:extra]
    assert find_runs(words) == _runs(words)


def test_run_queries_match_brute_force(spark):
    from tripledger.llm.op13_periodic_runs import periodic_runs, plant

    rng = random.Random(4)
    words = ["aé", "b", "c", "dd"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 200))) for _ in range(120)]
    texts += [None, "", " \n", "x", "go " * 9, "a b \t a b\na b a b a b", "z z " * 8,
              "long " * 5000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "u v " * 10), (5, texts[5])]
    table = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows],
                                  f"doc_id long, text string, {EXTRA}").repartition(3)
    for rewrite in (None, plant):
        expected = []
        for doc_id, text in rows:
            own = (text or "").encode().split()
            if rewrite:
                own = rewrite(LEAST if doc_id is None else doc_id, own)
                h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
                if h % 10 == 0 and own:
                    n, g = len(own), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    assert all(own[i] == own[a + (i - a) % p] for i in range(a, n))
            runs = _runs(own)
            best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
            gone = {i for s, n, q in runs for i in range(s + q, s + n)}
            left = b" ".join(w for i, w in enumerate(own) if i not in gone)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
            expected.append((doc_id, len(own), len(runs), *best,
                             None if not runs else 1000 * best[1] // best[2],
                             hashlib.sha256(listed.encode()).hexdigest(),
                             hashlib.sha256(left).hexdigest(), left.decode()))
        found = [tuple(r) for r in periodic_runs(table, rewrite=rewrite).collect()]
        assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert periodic_runs(table.where("false")).count() == 0
