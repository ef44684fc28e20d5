"""What the bootstrap for personal data finds, against a plain version and by planted forms."""

import random
import time
from collections import Counter, defaultdict

import regex
from pyspark.sql import functions as F

from claimlake.llm import personal_data
from tests.llm.cases import ROWS, docs, rows_of, with_clashes
from tests.llm.test_corpus import BASE, PERSONAL, valid

PARAMS = personal_data.BootstrapParams()
TOKEN = regex.compile(r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\x0b\f\r]")
KINDS = list(BASE)


def pattern_before(text, start):
    if start and regex.match(r"[\p{L}\p{N}]", text[start - 1]):
        return None
    tokens = TOKEN.findall(text[:start].lower())
    return tuple(tokens[-2:]) if len(tokens) > 1 else None


def plain_mentions(text):
    base = [
        (m.start(), KINDS.index(kind), m.end())
        for kind, pattern in BASE.items()
        for m in regex.finditer(pattern, text)
        if valid(kind, m[0])
    ]
    like = [
        (m.start(), None, m.end())
        for m in regex.finditer(personal_data.CANDIDATE, text)
        if ("@" in m[0] or len(regex.sub("[^0-9]", "", m[0])) >= 5)
        and not any(s < m.end() and m.start() < e for s, _, e in base)
    ]
    mentions = [
        (s, k, e, regex.sub(r"[^\p{L}\p{N}@.]", "", text[s:e].lower()), pattern_before(text, s)) for s, k, e in base + like
    ]
    return base, [m for m in mentions if m[4]]


def plain(texts):
    """Spans of every text, by rounds over dictionaries."""
    found = [plain_mentions(t or "") for t in texts]
    edges, places = Counter(), Counter()
    for text, (_, mentions) in zip(texts, found):
        edges.update((p, instance, kind) for _, kind, _, instance, p in mentions)
        tokens = TOKEN.findall((text or "").lower())
        places.update(zip(tokens, tokens[1:]))
    instances = defaultdict(set)
    for p, instance, _ in edges:
        instances[p].add(instance)
    edges = {e: n for e, n in edges.items() if len(instances[e[0]]) >= PARAMS.min_support and places[e[0]]}
    scores = {(instance, kind): 1.0 for _, instance, kind in edges if kind is not None}
    while True:
        weights = defaultdict(float)
        for (p, instance, _), n in edges.items():
            for kind in range(len(KINDS)):
                weights[p, kind] += n * scores.get((instance, kind), 0.0)
        confident = {k: c for k, w in weights.items() if (c := round(min(1.0, w / places[k[0]]), 6)) >= PARAMS.min_confidence}
        best, known = {}, {instance for instance, _ in scores}
        for p, instance, kind in edges:
            if kind is None and instance not in known:
                for number in range(len(KINDS)):
                    if (p, number) in confident:
                        best[instance] = max(best.get(instance, (0, 0)), (confident[p, number], -number))
        if not best:
            break
        scores |= {(instance, -number): score for instance, (score, number) in best.items()}
    kinds = {}
    for (instance, kind), score in scores.items():
        kinds[instance] = max(kinds.get(instance, (0, -9)), (score, -kind))
    spans = []
    for base, mentions in found:
        extra = {
            (s, -kinds[i][1], e) for s, kind, e, i, p in mentions if kind is None and i in kinds and (p, -kinds[i][1]) in confident
        }
        spans.append(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted({*base, *extra})))
    return spans


def spans_of(spark, texts):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    found = personal_data.find_personal_data(with_clashes(docs(spark, rows)))
    got = rows_of(found.select("doc_id", personal_data.spans_text(F.col("spans")).alias("s")))
    assert len(got) == len(rows)
    return [s for _, s in sorted((r["doc_id"], r["s"]) for r in got)]


def test_by_brute_force(spark):
    rng = random.Random(5)
    phones = [lambda n: f"+1 (555) 010-{1000 + n}"] * 3 + [lambda n: f"555-010-{1000 + n}", lambda n: f"(555) 010-{1000 + n}"]
    mails = [lambda n: f"u{n}@host.org"] * 3 + [lambda n: f"u{n}@host", lambda n: f"Réf-{n}É.{n}@"]
    others = [lambda n: f"10.0.{n % 256}.7", lambda n: f"{n} {n + 1}", lambda n: f"Ref-{n}É.{n}00", lambda n: "parts"]
    leads = {"call me at ": phones, "tel:": phones, "mé\tat\n": phones, "<": mails, "mail to <": mails, "id=": mails}
    leads |= dict.fromkeys(["seen from ", "é ", "over ", "x", "((", "no.", ""], phones + mails + others)
    texts = []
    for _ in range(150):
        pieces = []
        for lead in rng.choices(list(leads), k=rng.randrange(1, 9)):
            pieces.append(lead + rng.choice(leads[lead])(rng.randrange(10, 60)))
        texts.append(rng.choice(["", "one two three "]) + rng.choice([" ", " and ", ", ", "\n"]).join(pieces))
    texts += texts[:5] + [r[1] for r in ROWS if len(r[1] or "") < 500] + [t for t in PERSONAL if len(t) < 5000]
    want = plain(texts)
    assert spans_of(spark, texts) == want
    assert sum(map(len, want)) > sum(len(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in plain_mentions(t or "")[0])) for t in texts)


def test_forms_behind_glued_prefixes_and_far_contexts(spark):
    planted = [
        ("call me at {}", [f"+1 (555) 010-{1000 + i}" for i in range(20)], ["(555) 123-4567", "555-123-9999", "5" * 90]),
        ("write tel:{} now", [f"+49 30 {100000 + i}" for i in range(20)], ["030-555-7788"]),
        ("mail <{}> please", [f"u{i}@x.org" for i in range(20)], ["someone@intranet", "a.b.c@corp"]),
        ("at his" + " " * 300 + "desk: {}", [f"v{i}@x.org" for i in range(20)], ["other@intranet"]),
        ("login" + "n" * 100 + " id={}", [f"w{i}@x.org" for i in range(20)], ["w@intranet" + "x" * 200]),
    ]
    texts, hidden = [], {}
    for frame, seeds, unseen in planted:
        texts += [frame.format(s) for s in seeds]
        for u in unseen:
            hidden[len(texts)] = u
            texts.append(frame.format(u))
    texts.append("sold 555-010-3333 parts of the 555-010-4444 kind")
    got = spans_of(spark, texts)
    for i, u in hidden.items():
        start = texts[i].index(u)
        assert got[i].split(":", 1)[1] == f"{start}:{start + len(u)}", texts[i]
    assert got[-1] == ""


def test_a_chain_of_five_rounds(spark):
    """Pattern k + 1 is confident only by what pattern k taught."""
    texts = [f"step zero 0: +1 555 010 10{i:02}" for i in range(18)] + [f"step zero 0: 77-000-0{j}" for j in range(2)]
    for k in range(1, 6):
        known = [f"77-{k - 1:03}-0{j}" for j in range(2)] * 9
        texts += [f"step k{k}: {s}" for s in (*known, f"77-{k:03}-00", f"77-{k:03}-01")]
    got = spans_of(spark, texts)
    assert got == plain(texts)
    assert all(s.startswith("phone:") for s in got[-4:])


def scan_seconds(spark, n):
    text = " ".join(f"id={100000 + i} u{i}@h.org" if i % 9 == 0 else f"no.{100000 + i}" for i in range(n))
    frame = docs(spark, [(1, text, None, None, None)]).coalesce(1)
    start = time.time()
    row = personal_data.scanned(frame, "doc_id", "text").select(F.size("mentions").alias("n"), F.size("base").alias("b")).first()
    # an address's first part needs a word before it
    assert row["b"] == len(range(0, n, 9)) and row["n"] >= n
    return time.time() - start


def test_many_candidates_take_time_in_proportion(spark):
    scan_seconds(spark, 100)
    assert scan_seconds(spark, 20_000) < 10
    assert scan_seconds(spark, 80_000) < 40


def test_long_runs_are_linear(spark):
    texts = ["a." * 200_000, "a" * 400_000, "12 " * 150_000, "1234567." * 50_000, "(" * 300_000, "x@" * 150_000]
    start = time.time()
    frame = docs(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    assert personal_data.scanned(frame, "doc_id", "text").select(F.size("mentions").alias("n")).agg(F.sum("n")).first() is not None
    assert time.time() - start < 60
