import random
import re
import time

from pyspark.sql import functions as F

from firmlens.llm import secret_ledger as S
from firmlens.session import run_dir

from .brute import edge_docs

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_spans(t):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def texts(n):
    r = random.Random(n)
    bits = ["token", "PassWord", "api_key", "apiKEY", "secret", ":", "=", " ", "'", '"', "AKIA", "AKIAABCDEFGH1234", "0123456789abcdef", "é", "日\U0001f642", "\n", "abcdefgh", "xyz", "-"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_brute_force(spark):
    made = texts(400)
    docs = spark.createDataFrame(list(enumerate(made)), "path long, text string").repartition(4)
    got = S.scan_versions(docs, run_dir(spark, "test_ledger")).collect()
    assert len(got) == len(made)
    for r in got:
        assert [(s.kind, s.start, s.end) for s in r.spans] == plain_spans(made[r.path]), made[r.path]
    assert sum(map(len, (r.spans for r in got))) > 100


def test_only_unseen_pairs_are_scanned(spark):
    ledger = run_dir(spark, "test_ledger")
    one = spark.createDataFrame([("a", "token=abcdefgh1"), ("b", "nothing"), ("c", "token=abcdefgh1")], "path string, text string")
    S.scan_versions(one, ledger).count()
    book = S.read_ledger(one, ledger)
    assert book.count() == 2 * len(S.RULES)  # two blobs, copies scanned once
    two = one.union(spark.createDataFrame([("d", "AKIA" + "A" * 16), ("e", "nothing")], "path string, text string"))
    got = {r.path: [s.kind for s in r.spans] for r in S.scan_versions(two, ledger).collect()}
    assert got == {"a": ["assign"], "b": [], "c": ["assign"], "d": ["access"], "e": []}
    assert S.read_ledger(one, ledger).count() == 3 * len(S.RULES)
    # a finding in the ledger is what counts for a seen pair; a new rule version is scanned anew
    changed = (S.RULES[0], S.Rule("access", "AKIA[A-Z]+", least=20, literal="AKIA"), S.RULES[2])
    got = {r.path: [s.kind for s in r.spans] for r in S.scan_versions(two, ledger, rules=changed).collect()}
    assert got["d"] == ["access"] and S.read_ledger(one, ledger).count() == 3 * len(S.RULES) + 3
    assert S.read_ledger(one, ledger).groupBy("blob", "rule", "version").count().where("count > 1").count() == 0


def test_edges(spark):
    docs = edge_docs(spark).withColumn("text", F.concat("text", F.lit(" token: abcdefghij")))
    got = S.scan_versions(docs, run_dir(spark, "test_ledger"), path="doc_id")
    assert got.count() == docs.count()
    assert got.where("size(spans) = 1").count() == docs.where("text IS NOT NULL").count()
    assert S.scan_versions(docs.limit(0), run_dir(spark, "test_ledger"), path="doc_id").count() == 0


def test_time_follows_the_hits_of_a_long_text(spark):
    took = {}
    for n in (2_000, 20_000, 40_000):
        made = " ".join(f"token=abcdefgh{k:06d}" if k % 3 else "token=short" for k in range(n))
        docs = spark.createDataFrame([(1, made)], "path long, text string")
        start = time.monotonic()
        [row] = S.scan_versions(docs, run_dir(spark, "test_ledger")).collect()
        took[n] = time.monotonic() - start
        assert [(s.kind, s.start, s.end) for s in row.spans] == plain_spans(made)
    assert took[40_000] < 2.5 * took[20_000] + 2, took


def test_blocks_of_matches(spark):
    made = [" ".join(["AKIA" + "B" * 12] * n) + " AKIA" for n in (1, 127, 128, 129, 255, 256, 257)]
    docs = spark.createDataFrame(list(enumerate(made)), "path long, text string")
    for r in S.scan_versions(docs, run_dir(spark, "test_ledger")).collect():
        assert [(s.kind, s.start, s.end) for s in r.spans] == plain_spans(made[r.path])
