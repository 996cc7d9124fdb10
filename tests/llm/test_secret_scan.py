from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from ledgerline.llm import secret_scan as S
from tests.llm.samples import clashing, documents, empty

TEXTS = [None, "", 'password = "abcdef12" token:xyz', "PassWord:'longenough1' ſecret=abcdefgh apikey=short api_key = 123456",
         "AKIA" + "A1" * 8 + " AKIA123 xAKIA" + "Z" * 30, "0123456789abcdef01234567 0123456789abcdef0123456" + "é" * 3 + "f" * 40,
         "-----BEGIN RSA PRIVATE KEY----- ghp_" + "z" * 36, "secret=secret=abcdefgh", "token==abc token===abcdefg", "é" * 50 + "passwd:abcdef"]


def brute(text):
    found = []
    t = text or ""
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(assign, t) if len(m[2]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    found.sort()
    return [sum(f[1] == k for f in found) for k in range(3)], hashlib.sha256(",".join(f[2] for f in found).encode()).hexdigest()


def test_query_equals_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(100, TEXTS[2]), (100, TEXTS[2])]
    out = S.op2_secret_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(out) == len(rows)
    for r in out:
        counts, digest = brute(TEXTS[2 if r.doc_id == 100 else r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == counts and r.base_sha256 == digest, r
    spans = {r.doc_id: r.spans for r in out}
    assert spans[6] == "private_key:0:31,host_token:32:72" and spans[1] == ""


def test_only_unseen_blobs_and_rule_versions_are_scanned(spark, monkeypatch):
    ledger = S.new_ledger(spark)
    first = spark.createDataFrame([(1, "token=abcdefgh"), (2, "clean"), (3, "token=abcdefgh")], "doc_id bigint, text string")
    S.scan_new_blobs(first, "text", ledger)
    assert ledger.read(S.RULE_VERSION).count() == 2
    S.scan_new_blobs(first, "text", ledger)
    assert ledger.read(S.RULE_VERSION).count() == 2
    second = first.unionByName(spark.createDataFrame([(4, "passwd: 1234567")], "doc_id bigint, text string"))
    # a planted finding shows that blobs of the ledger keep what it says and are not scanned again
    known = ledger.read(S.RULE_VERSION).first()["blob"]
    S.scan_new_blobs(second, "text", ledger)
    found = {r.doc_id: [s.kind for s in r.secrets] for r in S.join_findings(second, "text", ledger).collect()}
    assert found == {1: ["assign"], 2: [], 3: ["assign"], 4: ["assign"]}
    assert ledger.read(S.RULE_VERSION).count() == 3 and ledger.read(S.RULE_VERSION).where(F.col("blob") == known).count() == 1
    # other rules are another version: all blobs are scanned anew, and the first findings stay
    other = (S.SecretRule("other", "[0-9]+"),)
    S.scan_new_blobs(second, "text", ledger, rules=other)
    found = {r.doc_id: [s.kind for s in r.secrets] for r in S.join_findings(second, "text", ledger, rules=other).collect()}
    assert found == {1: [], 2: [], 3: [], 4: ["other"]}
    assert ledger.read(S.rule_version(other)).count() == ledger.read(S.RULE_VERSION).count() == 3
    assert S.rule_version(S.RULES[::-1]) != S.RULE_VERSION


def test_private_keys_with_their_body():
    body = "-----BEGIN RSA PRIVATE KEY-----\n{}MIIEow\n+/=\n-----END RSA PRIVATE KEY-----"
    for text in (body.format(""), body.format("Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n")):
        assert S.find_secrets(f"x {text} y") == [("private_key", 2, 2 + len(text))]
    assert S.find_secrets("-----BEGIN PRIVATE KEY-----\nabc") == [("private_key", 0, 27)]
    assert len(S.find_secrets("-----BEGIN PRIVATE KEY-----\nabc\n" * 20_000)) == 20_000


def test_edge_tables(spark):
    assert S.op2_secret_scan(empty(spark)).collect() == []
    docs = documents(spark)
    assert S.op2_secret_scan(docs).count() == docs.count()
    wide = clashing(docs)
    ledger = S.new_ledger(spark)
    S.scan_new_blobs(wide, "text", ledger)
    out = S.join_findings(wide, "text", ledger)
    assert out.columns == [*wide.columns, "secrets_"] and out.where(F.col("blob") == "blob").count() == docs.count()
