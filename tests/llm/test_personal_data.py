import random
import re
import time
from hashlib import sha256

import numpy as np
import pytest

from conftest import SF_CHECK
from mailsync.llm import personal_data as K

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(digits))]
            if kind == K.IP and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == K.CARD and not (16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0):
                continue
            if kind == K.PHONE and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_are_the_patterns():
    rng = random.Random(3)
    parts = ["a", ".", "@", "-", "1", "23", "456", "+", "(", ")", " ", "4111111111111111", "é", "1.2.3.4", "x.y", "%"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert K.base_spans(text) == brute(text), text


@pytest.mark.parametrize("part", ["a", "1", "a@", "1.", "+1(", "1 ", "(", "1:", "[at]", "tel ", "tel 1 ", "::", "call(", "phone 12-"])
def test_searches_are_linear(part):
    began = time.process_time()
    K.find_spans(part * (200_000 // len(part)) + "@")
    assert time.process_time() - began < 10


def test_base_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = {r.doc_id: r for r in K.personal_data(docs).collect()}
    for d in docs.collect():
        want, r = brute(d.text), rows[d.doc_id]
        text = ",".join(f"{K.KINDS[k]}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in want) for n in range(4)]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_method_adds_likely_spans_only(spark):
    texts = {1: "please write to jane.roe [at] mail [dot] example [dot] com today", 2: "our phone: (743) 555-3824, call",
             3: "order 123.456.7890123 and 12:30", 4: "ip 10.0.0.1 mail a@b.co card 4111 1111 1111 1111 tel +1 743 555 3824"}
    many = [(100 + i, f"mail x{i}@mail.example.com or call +1 (743) 555-{1000 + i} server 10.0.0.{i}") for i in range(60)]
    rows = {r.doc_id: r for r in K.personal_data(spark.createDataFrame([*texts.items(), *many], "doc_id long, text string")).collect()}
    assert rows[1].spans.startswith("email:16:") and rows[2].spans == "phone:11:25" and rows[3].spans == ""
    assert (rows[4].n_email, rows[4].n_ip, rows[4].n_card, rows[4].n_phone) == (1, 1, 1, 1)
    assert all(rows[i].n_added == 0 for i, _ in many)


def test_cues_propose_and_the_classifier_decides(spark):
    planted = {1: ("reach me, tel 030 12345678 or later", "phone:14:26"), 2: ("please call phone 06 12 34 56 78 today", "phone:18:32"),
               3: ("the server 2001:db8::1 is down", "ip:11:22"), 4: ("login at host fe80::1:2ab was seen", "ip:14:25"),
               5: ("Telefon: (030) 1234567, Herr", "phone:9:22")}
    clean = {11: "order number 030 12345678 shipped", 12: "std::vector and a::b of c++", 13: "at 12:30 and 10:45:59 in 2024",
             14: "call of duty 2019 and 2020", 15: "the year 1999 2000 2001", 16: "ratio 3:4 or 16:9"}
    many = [(100 + i, f"mail x{i}@mail.example.com or call +1 (743) 555-{1000 + i} server 10.0.0.{i}") for i in range(60)]
    many += [(300 + i, f"order {i} has 4 parts, see page {i * 7}") for i in range(60)]
    rows = [*((k, t) for k, (t, _) in planted.items()), *clean.items(), *many]
    got = {r.doc_id: r.spans for r in K.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k] for k in planted} == {k: want for k, (_, want) in planted.items()}
    assert {k: got[k] for k in clean} == dict.fromkeys(clean, "")


def test_ipv6():
    good = ["2001:db8::1", "::1:2", "1::2", "1:2:3:4:5:6:7:8", "fe80::1:2ab", "1:2:3:4:5:6:7::"]
    bad = ["12:30", "10:45:59", "a::b", "::", "1::2::3", "1:2:3:4:5:6:7:8:9", "12345::1", ":1:2", "1:2:3:4:5:6:7", "1::", "::1"]
    assert [K.is_ipv6(x) for x in good + bad] == [True] * len(good) + [False] * len(bad)


def test_em_recovers_reliabilities():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.4
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    votes = np.where((rng.random((20_000, 5)) < right) == truth[:, None], 2, 0)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    real, rates = K.estimate_reliabilities(patterns, counts.astype(float))
    assert rates[1, :, 2] == pytest.approx(right, abs=0.04) and rates[0, :, 0] == pytest.approx(right, abs=0.04)
    assert (real * counts).sum() / counts.sum() == pytest.approx(0.4, abs=0.03)


def test_edges(edge_docs, no_docs):
    rows = K.personal_data(edge_docs).collect()
    assert sorted((r.doc_id, r.n_card + r.n_ip) for r in rows if r.doc_id) == sorted(
        (r.doc_id, 0) for r in edge_docs.select("doc_id").collect() if r.doc_id)
    assert all(r.base_sha256 == sha256(b"").hexdigest() and r.spans == "" for r in rows)
    assert K.personal_data(no_docs).collect() == []
