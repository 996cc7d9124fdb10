from __future__ import annotations

import hashlib
import random
import re

from ledgerline.llm.pii import BASE_KINDS, find_personal, luhn, op4_pii, scan_personal
from tests.llm.samples import clashing, documents, empty


def brute(t):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub(r"[\x20-]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
              if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return [(BASE_KINDS[k], a, b) for a, k, b in sorted(found)]


def test_parsers_equal_the_patterns():
    rng = random.Random(7)
    for alphabet in ("a.@-b1", "1.2 -0", "+1 ().-2", "+12 .-(a@", "0123456789 -", "1234.", "a@.b-_%+é１"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 32)))
            assert [s for s in find_personal(text) if s[0] in BASE_KINDS] == brute(text), text


def test_further_kinds():
    text = "see ftp://bob:pw@h.org IBAN: GB82 WEST 1234 5698 7654 32, iban GB00WEST12345698765432 SSN 123-45-6789"
    assert [s for s in find_personal(text) if s[0] not in BASE_KINDS] == [("url_login", 10, 22), ("iban", 29, 56), ("ssn", 90, 101)]


def test_query_and_edge_tables(spark):
    texts = [None, "", "é a@b.co 1.2.3.4 4111 1111 1111 1111 +1 (555) 010-9999", "a@b.co", "a@b.co", "1" * 200000 + " x@y.zz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in op4_pii(df).collect():
        expected = brute(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == s[0] for s in expected) for k in BASE_KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in expected).encode()).hexdigest()
    assert op4_pii(empty(spark)).collect() == []
    wide = clashing(documents(spark))
    assert scan_personal(wide).columns == [*wide.columns, "personal_"] and scan_personal(wide).count() == wide.count()
