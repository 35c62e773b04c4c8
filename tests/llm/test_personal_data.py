"""Personal data: plain spans by the patterns themselves, disguises with planted places, and what must stay clean."""

import hashlib
import random
import re

import pytest

from brinework.llm import personal_data, queries

SF = "/root/testdata/sf0.01"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def holds(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def by_patterns(text):
    return sorted((m.start(), list(PATTERNS).index(k), k, m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m.group()))


def test_query_by_the_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_personal_data(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        plain = by_patterns(texts[r.doc_id])
        listed = [f"{k}:{a}:{b}" for a, _, k, b in plain]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == p[2] for p in plain) for k in PATTERNS)
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s in listed] == listed and r.n_added == len([s for s in r.spans.split(",") if s]) - len(listed)
    # the given texts have no disguises, but many a word for at
    assert sum(r.n_added for r in rows) == 0 and sum(r.n_email + r.n_phone for r in rows) > 10


def test_random_texts_by_the_patterns():
    rng = random.Random(2)
    for letters in ("ab@@..-+ 0123456789()%_", "0123456789.. -", "a@.-é", "+0123456789 ().-"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
            got = sorted((a, personal_data.KINDS.index(k), k, b) for k, a, b in personal_data.plain_spans(text))
            assert got == by_patterns(text), text


@pytest.mark.parametrize(
    "kind, disguised, value",
    [
        ("email", "jane.doe (at) example (dot) com", "jane.doe@example.com"),
        ("email", "jane [at] mail [dot] example [dot] org", "jane@mail.example.org"),
        ("email", "jane at example dot com", "jane@example.com"),
        ("email", "JANE AT EXAMPLE DOT CO DOT UK", "JANE@EXAMPLE.CO.UK"),
        ("email", "max_77 at mail.example.com", "max_77@mail.example.com"),
        ("email", "jane{at}example.com", "jane@example.com"),
        ("email", "jane &#64; example".replace(" ", "") + "&#46;com", "jane@example.com"),
        ("email", "jane%40example.com", "jane@example.com"),
        ("email", "juana arroba ejemplo punto es", "juana@ejemplo.es"),
        ("email", "max (ät) beispiel (punkt) de", "max@beispiel.de"),
        ("email", "jоhn@exаmple.com", "john@example.com"),
        ("email", "ｊａｎｅ＠example．com", "jane@example.com"),
        ("email", "jo​hn@exa­mple.com", "john@example.com"),
        ("email", "\U0001d423\U0001d428\U0001d41a\U0001d427@example.com", "joan@example.com"),
        ("phone", "plus four nine one seven six five five five one two three four", "+491765551234"),
        ("phone", "+1 nine seven four 555 three four three six", "+1 974 555 3436"),
        ("phone", "plus vier neun eins sieben sechs fünf fünf fünf eins zwei drei", "+49176555123"),
        ("phone", "+１ （9７４） 555-3436", "+1 (974) 555-3436"),
        ("card", "four one one one one one one one one one one one one one one one", "4111111111111111"),
        ("card", "four triple one, one one one one, one one one one, one one one one", "4111111111111111"),
        ("card", "4l11 1111 11I1 1111", "4111 1111 1111 1111"),
        ("card", "٤١١١ 1111 1111 1111", "4111 1111 1111 1111"),
        ("ip", "one nine two dot one six eight dot zero dot one", "192.168.0.1"),
        ("ip", "10 (dot) 0 [dot] 0 dot 17", "10.0.0.17"),
    ],
)
@pytest.mark.parametrize("around", [("", ""), ("Write to us: ", ", please."), ("\U0001f642 éè ", "\nThe end")])
def test_disguises(kind, disguised, value, around):
    text = around[0] + disguised + around[1]
    start = len(around[0])
    added = [s for s in personal_data.spans(text) if not s[3]]
    assert added == [(kind, start, start + len(disguised), False, value)]


@pytest.mark.parametrize(
    "clean",
    [
        "We met at home. Then we left at once for dot matrix shows.",
        "Look at example.com or meet at school.The rest follows",
        "one two three four five, one of six at seven",
        "plus one more and eight others; call extension 1234 six times",
        "version 1.2 point 4, at 10.30 point",
        "Это обычный текст at дома",
        "café (at) noon, arrive at dot, über at alles",
        "4111 1111 1111 1112 one",
    ],
)
def test_clean_texts(clean):
    assert [s for s in personal_data.spans(clean) if not s[3]] == []


def test_plain_spans_stay_beside_longer_ones():
    got = personal_data.spans("jоhn@example.com and ann@example.org")
    assert [(s[1], s[2], s[3]) for s in got] == [(0, 16, False), (2, 16, True), (21, 36, True)]


def test_way_back():
    """Random edits: every kept character leads back to itself, every replacement to its whole source."""
    rng = random.Random(3)
    for _ in range(2000):
        text = "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 30)))
        edits, at = [], 0
        while at < len(text):
            start = at + rng.randint(0, 4)
            end = min(len(text), start + rng.randint(1, 3))
            if start >= len(text):
                break
            edits.append((start, end, rng.choice(["", "X", "YZ"])))
            at = end
        new = personal_data.Rewritten(text, edits)
        place = 0
        for start, end, put in [*edits, (len(text), len(text), "")]:
            before = text[(edits[edits.index((start, end, put)) - 1][1] if (start, end, put) in edits and edits.index((start, end, put)) else 0 if (start, end, put) in edits else edits[-1][1] if edits else 0) : start]
            for k in range(len(before)):
                assert new.back(place + k, place + k + 1) == (start - len(before) + k, start - len(before) + k + 1)
            place += len(before)
            if put:
                assert new.back(place, place + len(put)) == (start, end)
            place += len(put)
        assert place == len(new.text)


def test_long_texts():
    for text in ("a" * 10**6, "1" * 10**6, "1." * 500_000, "@" * 300_000, "a@" * 300_000, "+1" * 300_000, "at " * 300_000, "one " * 100_000, "​" * 100_000, "(" * 300_000, " " * 10**6):
        personal_data.spans(text)


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a@b.cd", "y"), (3, "a@b.cd", "y"), (3, "a@b.cd", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = sorted(map(str, ((r.doc_id, r.n_email, r.spans) for r in personal_data.find(docs).collect())))
    assert got == sorted(map(str, [(1, 0, ""), (2, 0, ""), (None, 1, "email:0:6"), (3, 1, "email:0:6"), (3, 1, "email:0:6")]))
    assert personal_data.find(docs.limit(0)).collect() == []
    kept = personal_data.with_spans(docs, out="pii")
    assert kept.columns == ["doc_id", "text", "spans", "pii"] and [s.value for r in kept.where("doc_id = 3").collect() for s in r.pii] == ["a@b.cd"] * 2
