"""Line dedup, URL filter, personal data, similarity and contamination against plain versions."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from claimlake.llm import components, decontamination, line_dedup, personal_data, similarity, url_filter
from claimlake.llm.queries import URL_RULES
from tests.llm.cases import DOCS, ROWS, contamination, counted, docs, jaccard_links, rows_of, sha, with_clashes

# --- line dedup -------------------------------------------------------------


def plain_dedup(rows, ratio, least):
    pages, seen = Counter(), Counter()
    for _, text, _, site, _ in rows:
        pages[site] += 1
        seen.update({(site, x.strip(" \t\r")) for x in (text or "").split("\n") if x.strip(" \t\r")})
    out = []
    for doc, text, _, site, _ in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if not (seen[site, x.strip(" \t\r")] >= least and seen[site, x.strip(" \t\r")] > ratio * pages[site])
        ]
        some = sum(bool(x.strip(" \t\r")) for x in lines)
        out.append((doc, site, None if text is None else "\n".join(kept), some, len(lines) - len(kept)))
    return Counter(out)


def test_line_dedup(spark):
    rows = ROWS + [(100 + i, f"menu \nbody {i}\n\nmenu\nfoot", "en", "c" if i % 2 else None, 9) for i in range(20)]
    rows += [(200 + i, "tie" if i == 0 else f"x{i}", "en", "t", 3) for i in range(10)] + [(211, "tie\r", "en", "t", 3)]
    for params in (line_dedup.LineDedupParams(), line_dedup.LineDedupParams(2 / 11, 1)):
        got = line_dedup.without_boilerplate(with_clashes(docs(spark, rows)), params)
        names = ["doc_id", "source", "text", "n_lines", "n_dropped"]
        assert Counter(tuple(r[n] for n in names) for r in rows_of(got)) == plain_dedup(rows, params.max_ratio, params.min_pages)


# --- URL filter -------------------------------------------------------------


def plain_verdict(url, listed):
    match = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (match[1], match[2]) if match else ("", "")
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [
        r for r in URL_RULES
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])
    ]
    rule = max(fits, key=len, default=None)
    return host, path, rule, URL_RULES[rule] if rule else "block" if host in listed else "allow"


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://A.Example.ORG/es/1?x#y", "https://example.org/en/12", "http://org/", "http://xorg/",
        "http://a.org", "http://a.com/fr/://x", "http://b.com/de/", "http://É.COM/de", "x://bad.net?q", "x://bad.net#f", "://",
        "http://www.bad.net/a\nb?c", "http://ok.net/", "http://ok.net/",
    ]
    pages = spark.createDataFrame([(i if i else None, u, "") for i, u in enumerate(urls)], "page_id bigint, url string, html string")
    listed = spark.createDataFrame([("bad.net",), ("www.bad.net",), ("absent.net",), (None,)], "key string")
    for params in (url_filter.CascadeParams(), url_filter.CascadeParams(1, 1), url_filter.CascadeParams(max_filter_bits=1)):
        rows = rows_of(url_filter.judge_urls(with_clashes(pages), URL_RULES, listed, params))
        got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
        wanted = {(i or None, *plain_verdict(u, {"bad.net", "www.bad.net", "absent.net"})) for i, u in enumerate(urls)}
        assert got == wanted and len(rows) == len(urls)


def test_cascade_is_exact_with_poor_filters(spark):
    universe = spark.range(3000).select(F.concat(F.lit("h"), "id").alias("key"))
    listed = universe.where("cast(substring(key, 2) AS int) % 7 = 0")
    cascade = url_filter.build_cascade(listed, universe, url_filter.CascadeParams(2, 2))
    assert len(cascade.levels) > 2
    wrong = universe.where(cascade.contains(F.col("key")) != (F.col("key").substr(2, 9).cast("int") % 7 == 0))
    assert wrong.count() == 0


def test_empty_lists_and_tables(spark):
    none = spark.createDataFrame([], "key string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert rows_of(url_filter.judge_urls(pages, {}, none))[0]["verdict"] == "allow"
    assert url_filter.judge_urls(pages.limit(0), URL_RULES, none).count() == 0


# --- personal data ----------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def base_spans(text):
    found = [
        (m.start(), number, kind, m.end())
        for number, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text)
        if valid(kind, m[0])
    ]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


PERSONAL = [
    "é a@b.co, x@y a@b.com+x@d.org a@b@c.de .@-.- 1.2.3.4.5 256.1.1.1 0001.2.3.4 1.2.3 99999999999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111114111 4111111111111111  4111111111111111 12",
    "+1 (269) 555-3296 4524132264652876 +49 30 1234567. + 1 +12 +123456789 +1--------2 tel +1.2.3.4.5.6.7.8.9",
    "0" * 60_000 + " " + "a" * 60_000 + " " + "1." * 20_000 + " a@" + "b." * 20_000 + "c " + "5-" * 20_000,
    "1 " * 9 + "@" * 500 + "+" * 500,
    "\U0001f600 4111111111111111\n10.0.0.1",
]


def test_base_kinds(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(PERSONAL)] + ROWS
    got = rows_of(
        personal_data.find_personal_data(with_clashes(docs(spark, rows))).select(
            "doc_id", personal_data.spans_text(F.col("base")).alias("b"), personal_data.spans_text(F.col("spans")).alias("s")
        )
    )
    assert Counter((r["doc_id"], r["b"]) for r in got) == Counter((r[0], base_spans(r[1] or "")) for r in rows)
    assert all(set(filter(None, r["b"].split(","))) <= set(r["s"].split(",")) for r in got)
    assert personal_data.find_personal_data(docs(spark, [])).count() == 0


def test_contexts_reveal_unseen_identifiers(spark):
    seeds = [f"Hello {i}. Please call me +1 (555) 010-{1000 + i} soon" for i in range(6)]
    hidden = ["Hello. Please call me 555-010-2222 soon", "We sold 555-010-3333 parts of the 555-010-4444 kind"]
    rows = [(i, t, None, None, None) for i, t in enumerate(seeds + hidden)]
    got = rows_of(
        personal_data.find_personal_data(docs(spark, rows)).select(
            "doc_id", personal_data.spans_text(F.col("spans")).alias("s")
        )
    )
    spans = {r["doc_id"]: r["s"] for r in got}
    start = hidden[0].index("555")
    assert spans[6] == f"phone:{start}:{start + 12}" and spans[7] == ""


# --- components and similarity ----------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    random.seed(3)
    names = list(range(300))
    random.shuffle(names)
    pairs = [(names[i], names[i + 1]) for i in range(120)] + [(names[150], names[i]) for i in range(151, 200)] + [(7, 7), (names[1], names[0])]
    found = {r["node"]: r["root"] for r in rows_of(components.components(spark.createDataFrame(pairs, "a bigint, b bigint")))}
    groups = defaultdict(set)
    for node, root in found.items():
        groups[root].add(node)
    assert sorted(map(len, groups.values())) == [50, 121]
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def near_copies(n, seed):
    random.seed(seed)
    base = [f"w{random.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(random.choice([0, 1, 1, 2, 3, 4])):
            w[random.randrange(len(w))] = f"v{random.randrange(10**6)}"
        rows.append((1000 * seed + i, " ".join(w), "en", "a", 1))
    return rows


SHORT = [(11, "a b c", "", "", 0), (12, "A, b c!", "", "", 0), (13, "a b c d", "", "", 0), (13, "a b c d", "", "", 0)]


@pytest.mark.parametrize("small, block", [(32, 512), (1, 7), (4, 16)])
def test_links_and_classes(spark, small, block):
    rows = ROWS + SHORT + near_copies(60, 5) + near_copies(9, 6)
    params = similarity.SimilarityParams(small_bucket=small, block=block)
    frame = with_clashes(docs(spark, rows))
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in rows_of(similarity.links_per_document(frame, params)))
    links = jaccard_links([(r[0], r[1]) for r in rows])
    assert got == Counter((row[0], *link) for row, link in zip(rows, links))
    kept = rows_of(similarity.one_per_class(docs(spark, rows), params))
    classes = {link[0] for link in links if link[0] is not None}
    assert {r["doc_id"] for r in kept if r["doc_id"] is not None} == classes
    assert len(kept) == len(classes) + 1  # and the row without an id


def test_no_documents_and_no_links(spark):
    assert similarity.links_per_document(docs(spark, [])).count() == 0
    assert similarity.one_per_class(docs(spark, [])).count() == 0
    assert rows_of(similarity.links_per_document(docs(spark, ROWS[2:4])))[0]["n_links"] == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    least = similarity.least_matches(similarity.SimilarityParams())
    assert list(least) == list(range(16, 129, 16))
    assert all(m < 0.8 * n for n, m in least.items()) and least[128] > 60


# --- contamination ----------------------------------------------------------


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_contamination_by_brute_force(spark):
    random.seed(11)
    vocabulary = [f"t{i}" for i in range(40)] + ["été", "ÉTÉ", "x1"]
    text = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(i, text(random.choice([1, 2, 5, 12, 13, 14, 30, 60]))) for i in range(1, 30)]
    items += [(40, "solo"), (41, None), (42, ""), (43, items[3][1]), (43, text(20)), (44, "echo " * 20), items[5]]
    rows = list(ROWS)
    for i in range(60):
        parts = [text(random.choice([0, 3, 30, 200]))]
        for _ in range(random.choice([0, 1, 2])):
            w = (random.choice(items)[1] or "").split()
            a = random.randrange(max(1, len(w) - 12))
            parts += [" ".join(w[a : a + random.choice([12, 13, 40])]).upper(), text(random.choice([0, 5]))]
        rows.append((1000 + i, "; ".join(parts), "en", "a", 1))
    rows += [(2000, "echo " * 50, "", "", 0), rows[-1], (2001, "Solo, and more", "", "", 0)]
    got = rows_of(decontamination.judged(with_clashes(docs(spark, rows)), items_frame(spark, items)))
    seen = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"]) for r in got)
    wanted = contamination([(r[0], r[1]) for r in rows], items)
    assert seen == Counter((d, n, h, tuple(i), c) for d, n, h, i, c in wanted)
    assert any(r[4] for r in wanted) and not all(r[4] for r in wanted)


def test_no_items_and_no_documents(spark):
    none = items_frame(spark, [])
    assert all(r["n_hit"] == 0 for r in rows_of(decontamination.judged(docs(spark), none)))
    assert decontamination.judged(docs(spark, []), items_frame(spark, [(1, "a b")])).count() == 0


def test_carried_columns(spark):
    got = decontamination.judged(docs(spark), items_frame(spark, [(1, "a b")]), carry=("text", "lang"))
    assert counted(got.select("doc_id", "text", "lang")) == counted(docs(spark).select("doc_id", "text", "lang"))
    assert DOCS and sha("")
