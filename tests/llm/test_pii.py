import hashlib
import random
import re

import pytest

from martforge.llm import pii

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(d):
    v = [int(c) for c in d]
    return (sum(v[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in v[-2::-2])) % 10 == 0


def brute(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if [True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 12 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15][k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_plain_spans_against_the_patterns():
    rng = random.Random(3)
    alphabet = "ab.@-_+ 0123456789()%é\n"
    for _ in range(6000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert pii.find(text) == brute(text), text
        text = "".join(rng.choice("0123. -+@a") for _ in range(rng.randrange(80)))
        assert pii.find(text) == brute(text), text
    for text in ["4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (499) 555-6503.", "a@b.c@d.e", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8",
                 "256.1.1.1 001.002.003.004", "1" * 5000 + "." + "2" * 5000, "@" * 500, "a" * 3000 + "@", "+" * 300 + "1 " * 300]:
        assert pii.find(text) == brute(text), text[:50]


@pytest.mark.parametrize("text, kind, part", [
    ("write to jane.doe [at] example [dot] com now", 0, "jane.doe [at] example [dot] com"),
    ("write to jane (at) mail.example (dot) org.", 0, "jane (at) mail.example (dot) org"),
    ("reach jane at example dot com today", 0, "jane at example dot com"),
    ("mail usеr@exаmple.com ok", 0, "usеr@exаmple.com"),
    ("mail user＠example．com ok", 0, "user＠example．com"),
    ("mail us​er@example.com ok", 0, "us​er@example.com"),
    ("host 192 dot 168 dot 0 dot 12 up", 1, "192 dot 168 dot 0 dot 12"),
    ("host 10[.]0[.]0[.]1 up", 1, "10[.]0[.]0[.]1"),
    ("host one nine two dot one six eight dot one dot two up", 1, "one nine two dot one six eight dot one dot two"),
    ("card four one one one one one one one one one one one one one one one end", 2,
     "four one one one one one one one one one one one one one one one"),
    ("card ４１１１ １１１１ １１１１ １１１１ end", 2, "４１１１ １１１１ １１１１ １１１１"),
    ("call plus one four nine nine five five five six five zero three soon", 3,
     "plus one four nine nine five five five six five zero three"),
    ("ruf plus vier neun drei null eins zwei drei vier fünf an", 3, "plus vier neun drei null eins zwei drei vier fünf"),
])
def test_disguises_map_back_to_the_source(text, kind, part):
    base, every = pii.scan(text)
    start = text.index(part)
    assert (start, kind, start + len(part)) in every
    assert set(base) <= set(every) and base == brute(text)


def test_ordinary_words_stay():
    for text in ["we met at noon. The one who was at the inn is at home.", "un de deux la. Le point est un.", "see you at ten dot", ""]:
        assert pii.scan(text) == ([], [])


def test_tape_offsets_against_letters():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice("abcdefgh") for _ in range(40))
        tape, own = pii.Tape(text), [(i, i + 1) for i in range(40)]
        for _ in range(3):
            edits, at, new = [], 0, []
            while at < len(tape.text):
                step = rng.randrange(1, 9)
                end = min(len(tape.text), at + rng.randrange(1, 4))
                put = "XYZ"[:rng.randrange(3)]
                edits.append((at, end, put))
                new += [(own[at][0], own[end - 1][1])] * len(put)
                new += own[end:end + step]
                at = end + step
            tape, own = tape.rewrite(edits), new
            assert len(own) == len(tape.text)
            for _ in range(20):
                if len(own) < 2:
                    break
                a = rng.randrange(len(own) - 1)
                b = rng.randrange(a + 1, len(own) + 1)
                assert tape.source(a, b)[:2] == (own[a][0], own[b - 1][1])


def test_table(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a@b.cc", "x"), (3, "x a@b.cc +1 (499) 555-6503", "x"), (3, "x a@b.cc +1 (499) 555-6503", "x"),
            (4, "w " * 50_000 + "1.2.3.4", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(pii.find_pii(docs).collect(), key=lambda r: str(r.doc_id))
    assert [r.spans for r in got] == ["", "", "email:2:8,phone:9:26", "email:2:8,phone:9:26", "ip:100000:100007", "email:0:6"]
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got] == [(0,) * 4] * 2 + [(1, 0, 0, 1)] * 2 + [(0, 1, 0, 0), (1, 0, 0, 0)]
    assert pii.find_pii(docs.limit(0)).collect() == []


def test_whole_table(spark):
    from martforge.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op5_pii"](spark, d).collect()}
    for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect():
        base = brute(r.text or "")
        own = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(own.encode()).hexdigest()
        assert [got[r.doc_id][f"n_{k}"] for k in pii.KINDS] == [sum(b[1] == i for b in base) for i in range(4)]
