from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from datetime import date

import numpy as np
import pytest
from awkward import AWKWARD, docs
from pyspark.sql import functions as F

from quarry.llm import line_dedup, pii, url_cascade
from quarry.llm.queries import LISTED_HOST, RULES

# --- URL filters -------------------------------------------------------------------

URLS = [
    (1, "https://a.example.org/es/1"), (2, "https://example.org/en/12?x#y"), (3, "http://EXAMPLE.org/En/1"), (4, "ftp://x.com/fr/"),
    (5, "http://com/de/9"), (6, "http://notcom/de/9"), (7, "http://x.notexample.org/es/"), (8, "https://x.org"), (9, "https://x.org?/es/"),
    (10, None), (11, "no scheme.org/es/"), (12, ""), (13, "://"), (14, "a://b://org/c"), (15, "http://www.spam-farm.net/en/1"),
    (15, "http://www.spam-farm.net/en/1"), (16, "http://spamfarm.net/en/1"), (17, "http://casino.com/fr/x"), (18, "http://casino.com/en/x"),
    (None, "http://ADULT-x.net/"), (19, "http://h\u00c4us.org/\nes/"), (20, "http://u:p@org:80/"), (21, "http://example.org/es"),
]


def brute_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    listed = bool(re.search(LISTED_HOST, host))
    rule, verdict = max(fits)[1:] if fits else (None, "block" if listed else "allow")
    return host, path, rule, verdict, listed


@pytest.mark.parametrize("shard_keys", [2, 100_000])
def test_judged_urls(spark, shard_keys):
    pages = spark.createDataFrame([(*u, "<p>", "x", "y") for u in URLS], "page_id long, url string, html string, host string, rule string")
    got = url_cascade.judge(pages, RULES, lambda h, p: h.rlike(LISTED_HOST), shard_keys=shard_keys).collect()
    assert Counter(map(tuple, got)) == Counter((i, *brute_verdict(u)) for i, u in URLS)
    assert url_cascade.judge(pages.limit(0), RULES, lambda h, p: h.rlike(LISTED_HOST)).collect() == []


@pytest.mark.parametrize("share", [0.0, 0.01, 0.5, 0.97, 1.0])
def test_cascade_is_exact_over_its_universe(share):
    rng = np.random.default_rng(4)
    h1, h2 = (rng.integers(0, 2 ** 63, 20_000).astype(np.uint64) for _ in range(2))
    listed = rng.random(20_000) < share
    levels = url_cascade.build(h1, h2, listed)
    assert (url_cascade.contains(levels, h1, h2) == listed).all()
    if share == 0.01:
        assert sum(len(b) for _, _, b in levels) * 8 < 20 * listed.sum()
    with pytest.raises(ValueError):
        url_cascade.build(h1[[0, 0]], h2[[0, 0]], np.array([True, False]))


def test_cascades_in_blocks(spark):
    keys = spark.range(5_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("on"))
    built = url_cascade.cascade(keys, "key", "on", shard_keys=500)
    rows = built.collect()
    assert sum(r["keys"] for r in rows) == 5_000 and sum(r["listed"] for r in rows) == 715 and len(rows) == 10
    hashes = keys.select(*url_cascade._hashes(F.col("key")), "on").toPandas().to_numpy()
    for block_bytes in (1, 1 << 20):
        listed = url_cascade.member(built, block_bytes)
        del_value = spark.sparkContext.parallelize([hashes.tolist()], 1).map(
            lambda rows: listed(np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64)).tolist()).collect()[0]
        assert del_value == [bool(r[2]) for r in hashes]


# --- line dedup -----------------------------------------------------------------------

def brute_lines(rows, min_sites):
    sites = defaultdict(set)
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            if s is not None and x.strip(" "):
                sites[x.strip(" ")].add(s)
    bad = {x for x, s in sites.items() if len(s) >= min_sites}
    out = Counter()
    for i, t, _ in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if x.strip(" ") not in bad]
        out[i, len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)] += 1
    return out


def test_lines_by_brute_force(spark):
    rng = random.Random(3)
    common = [f"common line {i}" for i in range(40)]
    rows = [(i, t, f"s{k % 4}") for k, (i, t) in enumerate(AWKWARD)]
    for i in range(400):
        lines = [rng.choice(["", "  "]) + rng.choice(common) + rng.choice(["", " "]) if rng.random() < 0.3 else f"own {i} {j}" for j in range(rng.randint(0, 12))]
        rows.append((100 + i // 2, "\n".join(lines), rng.choice(["hot", "hot", None, f"s{rng.randint(0, 60)}"])))
    rows += [(900 + i, "everywhere\n\nunique " + str(i) + "\neverywhere", f"s{i}") for i in range(60)]
    schema = "doc_id long, text string, source string, a string, b long, __id long"
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], schema).repartition(4)
    for k in (2, 5, 45):
        got = line_dedup.remove_boilerplate(df, k).collect()
        assert Counter(map(tuple, got)) == brute_lines(rows, k)
    assert line_dedup.remove_boilerplate(df.limit(0), 2).collect() == []


def test_listed_hosts_with_line_ends(spark):
    """A host that ends in a line break is not the listed word."""
    from quarry.llm.queries import LISTED_HOST

    hosts = ["spam", "spam\n", "a.spam", "x-bets.org", "\nspam", "spam\r", "nospam", ""]
    got = {r["h"]: r["on"] for r in spark.createDataFrame([(h,) for h in hosts], "h string").select("h", F.col("h").rlike(LISTED_HOST).alias("on")).collect()}
    assert got == {h: h in ("spam", "a.spam", "x-bets.org") for h in hosts}


# --- PII -----------------------------------------------------------------------------

KEY = b"test"


def test_permutation():
    for n in (1, 2, 3, 10, 97, 1000):
        image = [pii.permute(x, n, KEY, "t") for x in range(n)]
        assert sorted(image) == list(range(n))
        assert [pii.permute(x, n, KEY, "t", True) for x in image] == list(range(n))
    assert pii.permute(5, 10 ** 30, KEY, "t") != pii.permute(5, 10 ** 30, b"other", "t")


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def test_values_keep_their_format_and_links():
    t = ("Mail mkcsfe.18@mail1.example.com, call 1 (444) 555-4984 or +1 632-555-4827, card 4571475004921503 and 4571-4750-0492-1503, "
         "host 99.52.99.129. Born 1980-02-29, 29/02/1980 or 02/29/1980; SSN 123-45-6789, IBAN DE89 3704 0044 0532 0130 00")
    out, counts = run(t)
    assert counts == {"email": 1, "phone": 2, "card": 2, "ip": 1, "date": 3, "ssn": 1, "iban": 1}
    assert back(t) == t
    assert re.sub(r"\d", "0", re.sub(r"99\.52\.99\.129|\d+\.\d+\.\d+\.\d+", "ip", re.sub(r"[a-z]+\.\d\d@", "@", t))) == \
        re.sub(r"\d", "0", re.sub(r"\d+\.\d+\.\d+\.\d+", "ip", re.sub(r"[a-z]+\.\d\d@", "@", out)))
    for v in ("mkcsfe.18", "444) 555-4984", "4571475004921503", "99.52.99.129", "1980-02-29", "123-45-6789", "3704 0044"):
        assert v not in out
    one, two = re.search(r"card (\d{16}) and ([\d-]{19})", out).groups()
    assert one == two.replace("-", "") and luhn(one)
    date.fromisoformat(re.search(r"\d{4}-\d\d-\d\d", out)[0])
    iban = re.search(r"DE\d\d [\d ]+\d\d", out)[0].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_what_fails_validation_stays():
    t = "1234567812345678 0000000000000000 999.1.1.1 1.2.3.4.5 000-12-3456 1980-02-30 @x a@b 1 (144) 555-1234 12345 v1.5 DE00 3704 0044 0532 0130 00"
    assert pii.pseudonymise(t, KEY) == (t, [])


@pytest.mark.parametrize("text, value, kind", [
    ("IBAN DE89370400440532013000 BIC COBADEFFXXX", "DE89370400440532013000", "iban"),
    ("DE89 3704 0044 0532 0130 00 EUR 50", "DE89 3704 0044 0532 0130 00", "iban"),
    ("NL91ABNA0417164300 A", "NL91ABNA0417164300", "iban"),
    ("AB12 DE89370400440532013000", "DE89370400440532013000", "iban"),
    ("card 4111 1111 1111 1111 123", "4111 1111 1111 1111", "card"),
    ("card 4111-1111-1111-1111 12/27", "4111-1111-1111-1111", "card"),
    ("1235 4111 1111 1111 1111", "4111 1111 1111 1111", "card"),
])
def test_values_beside_capitals_and_digits(text, value, kind):
    out, counts = run(text)
    assert counts == {kind: 1} and value not in out
    before, after = text.split(value)
    assert out.startswith(before) and out.endswith(after) and len(out) == len(text)
    new = out[len(before):len(out) - len(after)]
    assert run(value)[0] == new and run(new)[1] == {kind: 1} and back(text) == text


CONTEXTS = ["{}", "card {} ok", "{} 123", "{}, 123", "a{{{}}}b", "({})", "No. {}.", "{}\n4111", "x {} 7 {}", "pay {} EUR 50", "{}/12", "{} 12/27",
            "born 01/02/1999 {} 1.2.3.4", "\u00e9 {} \u4e2d", "{};{}", "<td>{}</td>", "{} {}", "{} 9"]


def test_one_value_one_pseudonym_in_every_context():
    """The value alone decides: planted at known places, it is replaced there by what it gives alone, and comes back."""
    rng = random.Random(9)
    cards = {b + pii.luhn_digit(b) for b in (f"4{rng.randint(10 ** 13, 10 ** 14 - 1)}" for _ in range(400))}
    alone = {d: run(d)[0] for d in cards}
    assert len(set(alone.values())) == len(cards)
    for d, new in alone.items():
        parts = lambda x: " ".join(x[i:i + 4] for i in range(0, 16, 4))
        for context in CONTEXTS:
            text = context.format(*[parts(d)] * 2)
            out, _ = run(text)
            assert out.count(parts(new)) == text.count(parts(d)), (text, out)
            assert back(text) == text


def test_many_values_have_as_many_pseudonyms():
    """10^5 values in mixed contexts."""
    rng = random.Random(10)
    seen = {}
    for n in range(100_000):
        b = f"5{10 ** 12 + n * 7919 * 10 ** 4 + rng.randint(0, 9999):014d}"
        v = b + pii.luhn_digit(b)
        out, spans = pii.pseudonymise(rng.choice(("{}", "{} 123", "a {} b")).format(v), KEY)
        (start, length, kind), = spans
        assert kind == "card" and seen.setdefault(out[start:start + length], v) == v
    assert len(seen) == len(set(seen.values()))


def test_documents_by_a_plain_version(spark):
    """Texts put together from values and words; the plain version replaces each value by its kind's permutation and knows no search."""
    rng = random.Random(11)
    rows, want = [], {}
    for i in range(300):
        old, new = [], []
        for _ in range(rng.randint(0, 12)):
            kind, v = rng.choice([("email", f"u{rng.randint(0, 99)}@d{rng.randint(0, 3)}.example.com"), ("ip", f"10.{rng.randint(0, 255)}.0.{rng.randint(1, 255)}"),
                                  ("ssn", f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"), ("date", f"19{rng.randint(10, 99)}-03-{rng.randint(1, 28):02d}"),
                                  ("phone", f"({rng.randint(200, 999)}) 555-{rng.randint(0, 9999):04d}"), (None, rng.choice(["word", "12", "\n", "x-1", "EUR"]))])
            old.append(v)
            new.append(pii._BY_KIND[kind](v, KEY, False) if kind else v)
        rows.append((i, " and ".join(old)))
        want[i] = " and ".join(new)
    df = pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), KEY)
    assert {r["doc_id"]: r["text"] for r in df.collect()} == want
    assert sorted(map(tuple, pii.restored(df, KEY).collect())) == rows


def run(text):
    """The new text and how many values of each kind there were."""
    out, spans = pii.pseudonymise(text, KEY)
    return out, dict(Counter(k for _, _, k in spans))


def back(text):
    return pii.restore(*pii.pseudonymise(text, KEY), KEY)


@pytest.mark.parametrize("shape", ["card", "phone", "ip", "ssn", "date", "email"])
def test_round_trip_of_many_values(shape):
    rng = random.Random(shape)
    seen = {}
    for _ in range(300):
        n = lambda a, b: rng.randint(a, b)
        v = {"card": lambda: (b := f"{n(10 ** 14, 10 ** 15 - 1)}") + pii.luhn_digit(b), "phone": lambda: f"1 ({n(200, 999)}) {n(100, 999)}-{n(0, 9999):04d}",
             "ip": lambda: f"{n(1, 255)}.{n(0, 255)}.{n(0, 255)}.{n(0, 255)}", "ssn": lambda: f"{n(1, 665):03d}-{n(1, 99):02d}-{n(1, 9999):04d}",
             "date": lambda: rng.choice(["{0}-{1:02d}-{2:02d}", "{2:02d}/{1:02d}/{0}", "{1:02d}/{2:02d}/{0}"]).format(n(1900, 2099), n(1, 12), n(1, 28)),
             "email": lambda: f"{''.join(rng.choices('abcXYZ019', k=n(1, 9)))}@d{n(0, 3)}.example.com"}[shape]()
        out, counts = run(f"x {v} y")
        assert counts == {shape: 1}, (v, out)
        assert back(f"x {v} y") == f"x {v} y"
        assert seen.setdefault(out, v) == v


def test_documents(spark):
    rows = [*AWKWARD, (90, "a 4571475004921503"), (91, "b 4571475004921503"), (92, "4571 " * 30_000)]
    got = pii.pseudonymised(docs(spark, rows), KEY).collect()
    want = Counter((i, None if t is None else pii.pseudonymise(t, KEY)[0]) for i, t in rows)
    assert Counter((r["doc_id"], r["text"]) for r in got) == want
    by = {r["doc_id"]: r for r in got}
    assert by[90]["n_card"] == 1 and by[90]["text"][2:] == by[91]["text"][2:] != "4571475004921503"
    assert pii.pseudonymised(docs(spark, rows).limit(0), KEY).collect() == []
