"""Classifiers, secrets, archives and the pipeline against brute force, round trips and held-out labels."""

import base64
import gzip
import hashlib
import json
import math
import random
import re
import resource
import subprocess
import sys
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from windrow.llm import exact_dedup, packing, quality, secret_scan, simhash, toxicity, warc
from windrow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def held(spark, name, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = QUERIES[name](spark, SMALL).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    return [(labels[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in labels]


def test_quality_held_out(spark):
    rows = held(spark, "op3_quality", "quality")
    assert np.mean([y == p for y, p, _ in rows]) >= 0.97
    assert np.mean([p for y, p, _ in rows if y == 1]) >= 0.98


def test_toxicity_held_out(spark):
    rows = held(spark, "op6_toxicity", "toxic")
    assert np.mean([y == p for y, p, _ in rows]) >= 0.95
    assert np.mean([p for y, p, _ in rows if y == 0]) <= 0.01


def test_prior_and_risk():
    """Two overlapping clouds: the prior is found without negatives, and positives are told from negatives."""
    rng = np.random.default_rng(1)
    positive = rng.normal(1.5, 1, (4000, 6))
    unlabelled = np.concatenate([rng.normal(1.5, 1, (2400, 6)), rng.normal(-1.5, 1, (1600, 6))])
    model = quality.fit(positive, unlabelled)
    assert abs(model.prior - 0.6) < 0.08
    assert (model.score(rng.normal(1.5, 1, (500, 6))) > 0.5).mean() > 0.95
    assert (model.score(rng.normal(-1.5, 1, (500, 6))) < 0.5).mean() > 0.95


def test_features_by_hand():
    x = dict(zip(quality.BYTE_KINDS, quality.feature_rows(pa.array(["AB ab! ab", ""]))[0] ** 2, strict=False))
    assert x["upper"] == pytest.approx(2 / 9) and x["space"] == pytest.approx(2 / 9) and x["shout"] == pytest.approx(1 / 9)
    row = quality.feature_rows(pa.array(["", "AB ab! ab", ""]))
    assert np.exp(row[1][quality.N_KINDS]) - 1 == pytest.approx(3)
    assert row[1][quality.N_KINDS + 4] == pytest.approx(2 / 3)
    assert np.isfinite(row).all() and (row[0] == row[2]).all()


@pytest.mark.parametrize("operator, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_odd(spark, odd_docs, no_docs, operator, label):
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2, "x") for i in range(15)] + [(None, 1, 1, "x"), (3, None, None, "x"), (4, 0, 0, "x"), (4, 0, 0, "x")], "doc_id bigint, quality int, toxic int, text string")
    rows = operator.classify(odd_docs, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd_docs.select("doc_id").collect())
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert {r.score for r in rows if r.doc_id in (0, 1)} == {next(r.score for r in rows if r.doc_id == 1)}
    assert operator.classify(no_docs, labels).count() == 0
    rows = operator.classify(odd_docs, labels.limit(0)).collect()
    assert {r.score for r in rows} == {0.5}


def test_scores_ignore_other_columns(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    moved = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.lit(0))
    a = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in quality.classify(moved.repartition(5), labels).collect()}


def test_identity_swaps(spark):
    """Toxic texts name one group more often; with the penalty a neutral mention of it scores as any other."""
    rng = random.Random(1)
    neutral = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 3 == 0
        words = rng.choices(neutral, k=30) + (rng.sample(["vile", "scum", "idiot"], 1) if toxic else [])
        if rng.random() < (0.7 if toxic else 0.05):
            words.append("muslim")
        if rng.random() < 0.1:
            words.append("christian")
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    probes = pa.array(["w1 muslim w2", "w1 christian w2", "w1 w2", "w1 christian scum"])
    plain = toxicity.learn(docs, marks, fairness=0.0).score(probes)
    fair = toxicity.learn(docs, marks, fairness=1000.0).score(probes)
    assert plain[0] - plain[1] > 0.05
    assert abs(fair[0] - fair[1]) < 0.01 and fair[0] < 0.5 < fair[3]


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_one_text_for_each_id(spark, operator, monkeypatch):
    """An id on thousands of rows neither crowds out others nor brings its rows to the driver."""
    docs = spark.range(3000).selectExpr("CASE WHEN id < 2900 THEN -1L ELSE id END AS doc_id", "concat('word', id % 7, ' and more') AS text").repartition(4)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in [-1, *range(2900, 3000)]], "doc_id bigint, quality int, toxic int")
    seen = []
    fit = operator.fit
    monkeypatch.setattr(operator, "fit", lambda *a, **k: seen.append(a) or fit(*a, **k))
    scores = {r.score for r in operator.classify(docs, labels, sample_rows=10).collect()}
    assert all(0 <= x <= 1 for x in scores)
    sizes = [len(seen[0][0]), len(seen[0][1])] if operator is quality else [sum(seen[0][1] == 0), sum(seen[0][1] == 1)]
    assert sizes == [10, 10]


def adam(objective, w, steps, rate):
    """Plain Adam on numerical derivatives; ``objective`` gives the function to go down at a point."""
    mean, square = np.zeros(len(w)), np.zeros(len(w))
    for step in range(1, steps + 1):
        value = objective(w)
        gradient = np.array([(value(w + d) - value(w - d)) / 2e-5 for d in np.eye(len(w)) * 1e-5])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        w = w - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w


@pytest.mark.parametrize("prior", [0.2, 0.9])
def test_risk_by_loops(prior):
    """The non-negative risk, one row after the other; with a large prior its second term falls below zero."""
    rng = np.random.default_rng(3)
    p, u = rng.normal(0.8, 1, (30, 3)), rng.normal(-0.2, 1, (40, 3))
    turned = []

    def loss(rows, w, sign):
        return sum(math.log1p(math.exp(-sign * sum(a * b for a, b in zip(row, w)))) for row in rows) / len(rows)

    def objective(at):
        turned.append(loss(u, at, -1) - prior * loss(p, at, -1) < 0)
        decay = lambda w: 1e-4 / 2 * sum(x * x for x in w)
        if turned[-1]:
            return lambda w: prior * loss(p, w, -1) - loss(u, w, -1) + decay(w)
        return lambda w: prior * loss(p, w, 1) + loss(u, w, -1) - prior * loss(p, w, -1) + decay(w)

    want = adam(objective, np.zeros(3), 40, 0.05)
    np.testing.assert_allclose(quality.descend(p, u, prior, steps=40), want, atol=1e-5)
    assert any(turned) == (prior == 0.9)


def test_swap_penalty_by_loops():
    """Weighted loss and squared score changes over sentences whose terms are swapped one by one."""
    rng = np.random.default_rng(5)
    groups, width = [[0, 1, 2], [3, 4]], 8
    texts = [np.flatnonzero(rng.random(width) < 0.4) for _ in range(30)]
    toxic, weight = (rng.random(30) < 0.4).astype(float), rng.uniform(0.5, 2, 30)
    swapped = []
    for words in texts:
        for group in groups:
            for term in set(group) & set(words.tolist()):
                swapped += [(set(words.tolist()), (set(words.tolist()) - {term}) | {other}) for other in group if other != term]
    assert len(swapped) > 20

    def objective(_):
        def value(w):
            score = [sum(w[i] for i in words) + w[-1] for words in texts]
            loss = sum(g * math.log1p(math.exp(-z if y else z)) for g, z, y in zip(weight, score, toxic)) / weight.sum()
            change = [sum(w[i] for i in a) - sum(w[i] for i in b) for a, b in swapped]
            return loss + 1e-4 / 2 * (w[:-1] ** 2).sum() + 3.0 * sum(c * c for c in change) / len(change)

        return value

    base = (weight * toxic).sum() / weight.sum()
    want = adam(objective, np.append(np.zeros(width), math.log(base / (1 - base))), 40, 0.05)
    w, bias = toxicity.fit(texts, toxic, weight, width, groups, fairness=3.0, steps=40)
    np.testing.assert_allclose([*w, bias], want, atol=2e-4)


SECRETS = """db_password = "hunter2-Xy9Qz"
KEY="abcdEF123456"
api_secret = KEY
{"auth_token": "tok_9f8a7B6cDD", "name": "bob"}
private_key := 'AAAA1234bbbb' + "CCCC5678dd"
password_file = "/etc/some/pathX1"
password = "changeme"
<conn pwd="Zx9-qwerty77" host="x"/>
prose: nothing to see here, only words and a 10:30 time
"""


def base_brute(text):
    out = []
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out)]


def test_secrets_base(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in QUERIES["op8_secret_scan"](spark, SMALL).collect():
        want = base_brute(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex"))
        assert set(want) <= set(r.spans.split(","))


def test_secrets_added():
    base, added = secret_scan.all_spans(SECRETS)
    assert [f"{s.kind}:{s.start}:{s.end}" for s in sorted(base, key=lambda s: s.start)] == base_brute(SECRETS)
    assert {SECRETS[s.start : s.end] for s in added} == {"abcdEF123456", "AAAA1234bbbb", "CCCC5678dd", "Zx9-qwerty77"}
    hidden = secret_scan.redacted(SECRETS)
    assert "hunter2" not in hidden and "Zx9" not in hidden and "changeme" in hidden and hidden.count("[REDACTED]") == 6
    values = {p.name: p.value.text for p in secret_scan.pairs("a = 'xyz'\nb = a + \"uvw\"\nb += 'q'\nc: d: e\nf(g='h', i=b)")}
    assert values == {"a": "xyz", "b": "xyzuvwq", "d": "e", "g": "h", "i": "xyzuvwq"}
    (pair,) = secret_scan.pairs("b = 'xyz' + 'uvw'")
    assert [x.value for x in pair.value.new_literals()] == ["xyz", "uvw"] and not list(pair.value.new_literals())


HOSTILE = {
    "doubled constants": "password = 'abCD12!x'\n" + "password = password + password\n" * 40_000,
    "additions": "".join(f'password += "abcdEF{i % 10}h"\n' for i in range(100_000)),
    "additions of a constant in use": "".join(f'x += "abcdEF{i % 10}h"\ny = x\n' for i in range(50_000)) + "password = x",
    "sums with a long constant": "".join(f'x += "abcdEF{i % 10}h"\n' for i in range(20_000)) + "".join(f'password = x + "{i}"\n' for i in range(20_000)),
    "escaped quotes": 'password = "' + '\\"' * 500_000,
    "escaped quotes of both kinds": "password = '" + "\\'\\\"\"'" * 200_000,
    "open brackets": "password = " + "[" * 500_000,
    "open braces with names": "password = " + "{a:" * 200_000,
    "long subscript": "a[" + "x" * 1_000_000 + "] = 'abc'",
    "blank subscript": "a[" + " " * 1_000_000 + "b = 'abc'",
    "many subscripts": "a" + "['bcd']" * 100_000 + " = 'Zx9-qwerty77'",
    "blanks after a colon": ("password:" + " " * 1000) * 1000,
    "long literal": "password = '" + "".join(chr(256 + i % 5000) for i in range(1_000_000)) + "'",
    "many base matches": "password = abcdefABCDEF0123456789\n" * 20_000,
}


def test_secrets_hostile():
    """Time and memory grow with the text: each of these, up to 2 MB, takes seconds and less than 500 MB."""
    code = "import sys; sys.path[:0] = sys.argv[1:]; import test_llm_text as t; t.scan_hostile()"
    here = Path(__file__).resolve().parent
    done = subprocess.run([sys.executable, "-c", code, str(here), str(here.parents[1])], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    for name, (seconds, megabytes, _) in json.loads(done.stdout).items():
        assert seconds < 8 and megabytes < 500, name  # some 3 seconds at most where nothing else runs
    assert json.loads(done.stdout)["additions"][2] == 100_000 and json.loads(done.stdout)["doubled constants"][2] == 1


def scan_hostile():
    out = {}
    for name, text in HOSTILE.items():
        begin = time.process_time()
        found = len(secret_scan.all_spans(text)[1])
        out[name] = (time.process_time() - begin, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024, found)
    print(json.dumps(out))


def test_secrets_long_values():
    """A value too long to be kept as text scores by its counts; an unquoted subscript may have any length."""
    literal = "".join(random.Random(1).choices("abcXYZ0189-_", k=5000))
    for text in (f"password = '{literal}'", f"a = '{literal[:3000]}'\npassword = a + '{literal[3000:]}'"):
        hidden = secret_scan.redacted(text)
        assert literal[:100] not in hidden and literal[-100:] not in hidden
    assert not secret_scan.all_spans(f"password = '{'x' * 500}'")[1] and not secret_scan.all_spans(f"password = 'word {literal}'")[1]
    value = secret_scan.Value.sum([secret_scan.Value.of(secret_scan.Literal(0, 0, literal[i : i + 70])) for i in range(0, 4900, 70)])
    share = [literal[:4900].count(c) / 4900 for c in set(literal[:4900])]
    assert abs(value.score() - 0.6 - min(4, -sum(p * math.log2(p) for p in share)) / 10) < 1e-6
    text = f"password[{'i + ' * 50}1] = 'Zx9-qwerty77'"
    assert "Zx9" not in secret_scan.redacted(text)


def test_secrets_any_text():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice(["password", "TOKEN", "=", ":", "\"", "'", "abcdef0123456789", "AKIA", "QWERTYUIOP12345678", " ", "\n", "+", "\\", "ſecret", "é", "api_key", "x"]) for _ in range(30))
        base, added = secret_scan.all_spans(text)
        order = sorted(base, key=lambda s: (s.start, secret_scan.KINDS.index(s.kind)))
        assert [f"{s.kind}:{s.start}:{s.end}" for s in order] == base_brute(text)
        assert all(0 <= s.start < s.end <= len(text) for s in added)
        secret_scan.redacted(text)


SECRET_FORMS = [
    *('cfg["db_password"] = "Zx9-qwerty77"', "$c['db']['password'] = 'Zx9-qwerty77';", 'secrets["bob"] = "Zx9-qwerty77"'),
    *('db_password: str = "Zx9-qwerty77"', 'val apiToken: String = "Zx9-qwerty77"', 'def f(password: Optional[str] = "Zx9-qwerty77", x=1):'),
    *('db_password =\n  "Zx9-qwerty77"', 'db_password = (\n  "Zx9-"\n  "qwerty77"\n)', 'db_password = "Zx9-" +\n  "qwerty77"', 'db_password = "Zx9-"\n  + "qwerty77"'),
    *('{"db_password":\r\n  "Zx9-qwerty77"}', "db_password:\n  Zx9-qwerty77\nother: 1", "db_password: |\n  Zx9-qwerty77\n", "pwd = \\\n  'Zx9-qwerty77'"),
    *('"secrets": [\n  "Zx9-qwerty77"\n]', "secrets:\n  - Zx9-qwerty77\n", '"secret": {\n  "value": "Zx9-qwerty77"\n}', "secret:\n  value: Zx9-qwerty77\n"),
]


@pytest.mark.parametrize("text", SECRET_FORMS)
def test_secrets_forms(text):
    """Subscripts, typed names and values on later lines are listed and redacted, and nothing else is."""
    text = f"first line, no sign\n{text}\nname = \"Not-this-12\"\n"
    base, added = secret_scan.all_spans(text)
    assert not base and "".join(text[s.start : s.end] for s in sorted(added, key=lambda s: s.start)) == "Zx9-qwerty77"
    hidden = secret_scan.redacted(text)
    assert "[REDACTED]" in hidden and "Zx9" not in hidden and "qwerty" not in hidden and "Not-this-12" in hidden


def test_secrets_forms_rows(spark):
    docs = spark.createDataFrame(list(enumerate(SECRET_FORMS)), "doc_id bigint, text string")
    assert all(r.n_lexed > 0 for r in secret_scan.scan_secrets(docs).collect())
    assert all("qwerty77" not in r.text for r in secret_scan.redact(docs).collect())


@pytest.mark.parametrize("text", ['if token:\n    mode = "Strict-Mode-1"\n', "PASSWORD=\nNAME=Not-this-12\n", 'pwd = {\n}\nname = "Not-this-12"\n', '"secret": {"length": "Not-this-12"}'])
def test_secrets_other_lines(text):
    assert secret_scan.redacted(text) == text


def test_secrets_odd(odd_docs, no_docs):
    rows = secret_scan.scan_secrets(odd_docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd_docs.select("doc_id").collect())
    assert all(r.base == "" for r in rows if r.doc_id in (0, 1, 2))
    assert secret_scan.scan_secrets(no_docs).count() == secret_scan.redact(no_docs).count() == 0
    out = secret_scan.redact(odd_docs)
    assert out.columns == odd_docs.columns
    was, now = {r.doc_id: r for r in odd_docs.collect()}, {r.doc_id: r for r in out.collect()}
    assert now[0].text is None and now[11].text == was[11].text and now[11].n_chars == was[11].n_chars
    assert "abcDEF" not in now[16].text and now[16].n_chars == len(now[16].text)


@pytest.mark.parametrize("bait", [b"WARC/1.0\r\n", b"\r\nWARC/1.0\r\nA: b\r\n", b"\x1f\x8b\x08ab WARC/1.0\r\n", b"\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"])
def test_salvage_of_long_damage(bait):
    """What looks like a record every 200 bytes of 4 MB costs a second at most, and the record behind it is found."""
    data = (b"x" * 190 + bait) * 20_000 + record(1, b"payload")
    begin = time.process_time()
    found = list(warc.salvage(data))
    assert time.process_time() - begin < 1.5
    assert found[-1].payload() == b"payload" and sum(f.end - f.start for f in found) == len(data)


def member(record):
    return gzip.compress(record, mtime=0)


def record(i, payload, digest=True):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    seal = f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}\r\n" if digest else ""
    return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\n{seal}Content-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [False, True])
def test_salvage(packed):
    """Whatever bytes are changed, cut or put in, sound records outside the damage come back and all bytes are covered."""
    rng = random.Random(7)
    for _ in range(150):
        payloads = [bytes(rng.choices(b"ab \r\nWARC/1.0\r\n", k=rng.randint(0, 300))) for _ in range(8)]
        parts = [record(i, p) for i, p in enumerate(payloads)]
        parts = [member(p) for p in parts] if packed else parts
        hurt = set(rng.sample(range(8), rng.randint(0, 3)))
        for k in hurt:
            how = rng.randrange(3)
            cut = rng.randrange(10, len(parts[k]) - 10)
            if how == 0:
                parts[k] = parts[k][:cut]
            elif how == 1:
                parts[k] = parts[k][:cut] + bytes([parts[k][cut] ^ 0x5A]) + parts[k][cut + 1 :]
            else:
                parts[k] = rng.randbytes(rng.randint(1, 50)) + parts[k]
        data = b"".join(parts)
        found = list(warc.salvage(data))
        names = [f.fields.get("warc-record-id") for f in found if isinstance(f, warc.Record)]
        assert {f"<urn:page:{i}>" for i in range(8) if i not in hurt} <= set(names)
        read = {(f.fields.get("warc-record-id"), f.payload()) for f in found if isinstance(f, warc.Record)}
        assert {(f"<urn:page:{i}>", payloads[i]) for i in range(8) if i not in hurt} <= read
        at = 0
        for f in found:
            assert f.start == at or (packed and f.start < at)
            at = max(at, f.end)
        assert at == len(data)


def test_salvage_edges():
    assert list(warc.salvage(b"")) == []
    assert [type(x) for x in warc.salvage(b"junk")] == [warc.Gap]
    whole = member(record(1, b"x") + record(2, b"y"))
    assert [x.fields["warc-record-id"] for x in warc.salvage(whole)] == ["<urn:page:1>", "<urn:page:2>"]
    assert [x.payload() for x in warc.salvage(record(1, b"", digest=False))] == [b""]


def test_archives_odd(spark, tmp_path):
    """NULL, empty and equal payloads, odd urls, a NULL id; what is written comes back, and damage is told."""
    long = "é<p>" * 50_000
    rows = [(0, "http://a/b", "same"), (1, None, "same"), (2, "http://a/ b\r\nX: y", None), (3, "", ""), (4, "u", long), (5, "u", "one\r\n\r\nWARC/1.0\r\n\r\ntwo\n"), (9, "u", "same"), (None, "u", "same"), (7, "u", "last"), (7, "u", "last")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, digest string").repartition(2)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, archive_records=3)
    got = warc.read_archives(spark, path)
    assert got.filter("gap IS NOT NULL").count() == 0
    found = sorted((r.record_id, r.warc_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload) if r.payload is not None else None) for r in got.collect())
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        least = min(p for p, _, h in rows if p is not None and (h or "") == (html or ""))
        first = page_id == least
        urn = f"<urn:page:{'' if page_id is None else page_id}>"
        want.append((urn, "response" if first else "revisit", None if first else f"<urn:page:{least}>", len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), data if first else None))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(found, key=key) == sorted(want, key=key)
    warc.write_archives(pages, str(tmp_path / "small"), archive_bytes=100_000)
    sizes = [f.stat().st_size for f in (tmp_path / "small").glob("part-*")]
    assert len(sizes) == len(rows) and sorted(sizes)[-2] < 100_000
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    files = sorted((tmp_path / "archives").glob("part-*"))
    data = files[0].read_bytes()
    (tmp_path / "hurt").mkdir()
    (tmp_path / "hurt" / "a.warc").write_bytes(b"noise" + data[:40] + data)
    gaps = warc.read_archives(spark, str(tmp_path / "hurt"), payload=False).filter("gap IS NOT NULL").collect()
    assert [(g.start, g.end) for g in gaps] == [(0, 45)]


def test_archives_long_url(spark, tmp_path, monkeypatch):
    """Headers of any length are read; a page that cannot be read back stops the query."""
    rows = [(0, "http://a/b", "zero"), (1, "data:" + "x" * 100_000, "one"), (2, "http://a/WARC/1.0", "two"), (3, "data:" + "é" * 3_000_000, "zero")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in QUERIES["op4_warc"](spark, str(tmp_path)).collect()}
    assert got == {0: (4, "response", None), 1: (3, "response", None), 2: (3, "response", None), 3: (4, "revisit", 0)}
    write = warc.write_archives
    monkeypatch.setattr(warc, "write_archives", lambda pages, path: (write(pages, path), hurt(path)))
    with pytest.raises(Exception, match="gap in an archive"):
        QUERIES["op4_warc"](spark, str(tmp_path)).collect()


def hurt(path):
    file = next(f for f in Path(path.removeprefix("file:")).glob("part-*") if f.stat().st_size)
    file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(file.read_bytes().replace(b"zero", b"ZERO"))


def test_headers_end():
    """A header that is cut off ends at the next version line, and the record there is read."""
    cut = record(1, b"x")[:60]
    found = list(warc.salvage(cut + b"\r\n" + record(2, b"y")))
    assert [type(f) for f in found] == [warc.Gap, warc.Record] and found[0].reason == "header without end"


def test_pipeline(spark):
    """Each stage against its operator's own decisions, worked out by brute force where the operator does not learn."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality.classify(docs, labels).filter("predicted = 1").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact_dedup", "simhash", "secrets", "packing"]

    one = stages["quality"](spark, docs, SMALL)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == good
    clean = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert len(clean & good) >= 0.99 * len(clean)

    two = stages["exact_dedup"](spark, one, SMALL)
    last = {}
    for i in sorted(good):
        last[texts[i]] = i
    assert two.columns == docs.columns and {r.doc_id for r in two.collect()} == set(last.values())

    three = stages["simhash"](spark, two, SMALL)
    prints = {i: simhash.fingerprint(texts[i].encode()) for i in sorted(last.values())}
    kept, reach = [], {}
    for i in prints:
        if i in reach:
            continue
        kept.append(i)
        queue = [i]
        while queue:
            a = queue.pop()
            near = [b for b in prints if b not in reach and (prints[a] ^ prints[b]).bit_count() <= 4]
            reach.update(dict.fromkeys(near, i))
            queue += near
    assert {r.doc_id for r in three.collect()} == set(kept)

    four = stages["secrets"](spark, three, SMALL).collect()
    assert {r.doc_id: r.text for r in four} == {i: secret_scan.redacted(texts[i]) for i in kept}

    five = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter(r.doc_id for r in five if r.piece == 0) == Counter(kept)
    tokens = packing.word_ids(corpus_pipeline.module_file("word_bpe_49k.json"))
    assert sum(r.length for r in five) == sum(len(tokens.encode([r.text.encode()])[0]) // 4 + 1 for r in four)


def test_pipeline_odd(spark, odd_docs, no_docs):
    """Stages without labels take odd rows: repeated ones leave once, and every column comes through."""
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SMALL)
        assert out.columns == odd_docs.columns, name
        assert stage(spark, no_docs, SMALL).count() == 0
        docs = out
    assert exact_dedup.exact_dedup(docs).filter("NOT kept").count() == 0
    assert corpus_pipeline.pack(spark, docs, SMALL).filter("piece = 0").count() == docs.count()
    assert corpus_pipeline.keep_good(spark, no_docs, SMALL).count() == 0
    assert corpus_pipeline.keep_good(spark, odd_docs, SMALL).columns == odd_docs.columns
