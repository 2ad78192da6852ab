"""Secret scans: base patterns against a plain reading, the network's additions, edge rows."""

import hashlib
import re
import time

import numpy as np
from pyspark.sql import functions as F

from barforge.llm import queries
from barforge.llm import secrets as se
from tests.conftest import MEDIUM


def plain(text):
    """The patterns as stated, without any shortcut."""
    assign = re.compile("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
                        "[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(out)]


def test_query_equals_plain_reading_and_keeps_base_spans(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    rows = queries.QUERIES["op6_secrets"](spark, MEDIUM).collect()
    assert len(rows) == len(docs) and sum(r["n_assign"] for r in rows) > 0
    for r in rows:
        want = plain(docs[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for n, _, _ in want) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(filter(None, r["spans"].split(",")))


def test_base_spans_on_made_up_texts():
    rng = np.random.default_rng(3)
    bits = ["token", "Token", "api_key", "APIKEY", "ſecret", "password", " ", "=", ":", '"', "'", "AKIA", "AKIAAKIA1234ABCD",
            "0123456789abcdef" * 2, "deadbeef" * 4 + "f", "short", "longer.value/x=", "é", "\n", "ZZ99", "passwd:"]
    for _ in range(3000):
        text = "".join(rng.choice(bits, rng.integers(1, 12)))
        assert se.base_spans(text) == plain(text), text


def made(spark, n=400):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("etaoinshrdlu"), rng.integers(3, 9)))
    rows = []
    for i in range(n):
        body = " ".join(word() for _ in range(30)) + " " + "".join(word() for _ in range(4))
        if i % 2:
            body += f' token = "{rng.bytes(20).hex()}" ' + word()
        rows.append((i, body, "en", "x", 1))
    return rows


def test_network_finds_bare_values_and_leaves_prose(spark):
    docs = spark.createDataFrame(made(spark), "doc_id long, text string, lang string, found string, n_chars long")
    net = se.fit(docs)
    assert net is not None and 0.5 < net.threshold < 1
    rng = np.random.default_rng(9)
    bare = [f"some words {rng.bytes(14).hex()} go on" for _ in range(100)]
    prose = [r[1] for r in made(spark)[::2]]
    hit = [any(k == "model" for k, _, _ in s) for _, s in se.scan(bare, net)]
    assert np.mean(hit) > 0.9
    assert np.mean([bool(s) for _, s in se.scan(prose, net)]) < 0.02
    again = se.fit(docs.repartition(5))
    assert np.array_equal(net.filters, again.filters) and net.threshold == again.threshold


def test_no_filter_position_is_lost_between_rows():
    rng = np.random.default_rng(4)
    for n in (16, 17, 24, 40, 48, 100, 1000):
        text = "".join(rng.choice(list("abcdefXYZ0189"), n))
        sym = [se.char_class(c) + se.CLASSES for c in text]
        k = se.Network.KERNEL
        held = {tuple(r[j:j + k]) for r in se.encode(text, 0, n).tolist() for j in range(se.WIDTH - k + 1)}
        assert {tuple(sym[j:j + k]) for j in range(n - k + 1)} <= held, n


def test_network_learns_what_stands_behind_the_first_row(spark):
    # the first 48 symbols of a bare value and of a clean word are alike: context and 40 letters
    rng = np.random.default_rng(11)
    word = lambda n: "".join(rng.choice(list("etaoinshrdlu"), n))
    rows = []
    for i in range(400):
        tail = rng.bytes(16).hex().upper() if i % 2 else word(32)
        value = word(40) + tail
        rows.append((i, "some words " + (f'token = "{value}"' if i % 2 else value) + " go on"))
    net = se.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    bare = [f"some words {word(40)}{rng.bytes(16).hex().upper()} go on" for _ in range(100)]
    clean = [f"some words {word(72)} go on" for _ in range(100)]
    hit = lambda texts: np.mean([bool(s) for _, s in se.scan(texts, net)])
    assert hit(bare) > 0.9 and hit(clean) < 0.05


def test_rare_findings_are_sought_in_all_documents(spark):
    rng = np.random.default_rng(13)
    word = lambda n: "".join(rng.choice(list("etaoinshrdlu"), n))
    clean = [f"some words {word(24)} go on" for _ in range(200)]
    found = [f'some words token = "{rng.bytes(14).hex()}" go on' for _ in range(300)]
    # 60,000 documents, the findings in the 300 that come last by the hash of the id
    ids = [r[0] for r in spark.range(60_000).orderBy(F.xxhash64(F.col("id").cast("string"))).collect()]
    rows = [(i, clean[n] if n < 200 else found[n - 59_700] if n >= 59_700 else "plain words") for n, i in enumerate(ids)]
    net = se.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert net is not None
    bare = [f"some words {rng.bytes(14).hex()} go on" for _ in range(100)]
    assert np.mean([any(k == "model" for k, _, _ in s) for _, s in se.scan(bare, net)]) > 0.9


def test_edge_rows_and_redaction(spark):
    schema = "doc_id long, text string, spans string, base string, found string"
    long = "w " * 100_000 + 'password: "hunter22hunter"'
    rows = [(1, None, None, None, None), (2, "", "a", "b", "c"), (None, "passwd=abcdefgh1", "", "", ""),
            (3, long, None, None, None), (3, long, None, None, None), (4, "é token=12345678é", "", "", "")]
    docs = spark.createDataFrame(rows, schema)
    assert se.fit(docs) is None and se.fit(docs.limit(0)) is None
    out = se.findings(docs, None, name="f", redacted=True).collect()
    by = {r["doc_id"]: r["f"] for r in out}
    assert len(out) == 6 and by[1]["spans"] == by[2]["spans"] == "" and by[1]["redacted"] is None
    assert by[None]["base"] == "assign:0:16" and by[None]["redacted"] == "[secret]"
    assert by[3]["base"] == f"assign:200000:{len(long) - 1}" and by[4]["redacted"] == "é [secret]é"
    assert se.findings(docs.limit(0), None, name="f").count() == 0
    assert se.redact("abcdef", [("hex", 1, 3), ("hex", 2, 4)]) == "a[secret]ef"


def test_all_findings_teach_and_calibrate(spark, monkeypatch):
    rng = np.random.default_rng(17)
    pick = lambda letters, n: "".join(rng.choice(list(letters), n))
    texts = [" ".join(pick("etaoinshrdlu", 20) for _ in range(200)) for _ in range(35)]
    texts += [f'some words token = "{pick("0123456789abcdef", 28)}" go on' for _ in range(300)]
    findings = {(y, se.packed(rows)) for t in texts for y, rows in se.examples(t)}
    assert sum(y == 0 for y, _ in findings) > 6500
    seen, learn, curve = {}, getattr(se, "learn", None), se.curve

    def spy_learn(rows, *args):
        seen["learnt"] = {(r["y"], bytes(r["x"])) for r in rows.collect()}
        return learn(rows, *args)

    def spy_curve(scores, n):
        seen["unseen"] = scores.count() if hasattr(scores, "columns") else len(scores)
        return curve(scores, n)

    monkeypatch.setattr(se, "learn", spy_learn, raising=False)
    monkeypatch.setattr(se, "curve", spy_curve)
    monkeypatch.setattr(se, "ROUNDS", 1, raising=False)
    net = se.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert net is not None and len(seen.get("learnt", ())) + seen["unseen"] == len(findings)
    assert seen["learnt"] <= findings


def test_blocks_of_findings_do_not_depend_on_the_layout(spark, monkeypatch):
    docs = spark.createDataFrame(made(spark), "doc_id long, text string, lang string, found string, n_chars long")
    monkeypatch.setattr(se, "BLOCK_ROWS", 100)
    net, again = se.fit(docs), se.fit(docs.repartition(5))
    assert np.array_equal(net.filters, again.filters) and net.threshold == again.threshold


def odd_texts(n):
    rng = np.random.default_rng(19)
    bits = ["token", "Token", "api_key", "apiKEY", "ſecret", "SECRET", "password", "passw", " ", "   ", "=", ":", '"', "'", ".", "AKIA",
            "AKIAAKIA1234ABCD", "0123456789abcdef" * 2, "deadbeef" * 5, "short", "longer.value/x=", "é", "界", "😀", "\n", "\0", "\x85",
            "ZZ99", "passwd:", "etaoinshrdluetao", "x" * 70, "Ab0+/_=-" * 30]
    return ["".join(rng.choice(bits, rng.integers(1, 14))) for _ in range(n)]


def plain_examples(text):
    base, out = plain(text), []
    for m in re.finditer("[A-Za-z0-9+/_=-]{16,}", text):
        a, b = m.span()
        cover = [(s, e) for _, s, e in base if s <= a and b <= e]
        if cover or not any(s < b and a < e for _, s, e in base):
            out.append((int(bool(cover)), plain_rows(text, a, b)))
        if cover:
            s, e = min(cover)[0], max(e for _, e in cover)
            before = text[max(0, s - 16):s]
            out.append((1, plain_rows(before + m[0] + " " + text[e:e + 16].lstrip("\"'"), len(before), len(before) + b - a)))
    return out


def plain_rows(text, a, b):
    lo = max(0, a - 16)
    sym = [(se.char_class(c) if c.isascii() else 9) + 10 * (a <= i < b) for i, c in enumerate(text[lo:b + 16], lo)]
    starts = range(0, max(1, len(sym) - 4), 44)
    rows = [(sym[k:k + 48] + [0] * 48)[:48] for k in starts]
    return rows if len(rows) < 2 or len(sym) > starts[-1] + 4 else rows[:-1]


def test_examples_equal_a_plain_reading_of_odd_texts():
    texts = odd_texts(1500)
    for text in texts:
        assert se.base_spans(text) == plain(text), text
        got, want = se.examples(text), plain_examples(text)
        assert [(y, rows.tolist()) for y, rows in got] == want, text
        for _, rows in got:
            assert se.packed(rows) == np.unique(rows, axis=0).astype(np.int8).tobytes()
    assert [b for b, _ in se.scan(texts, None)] == [plain(t) for t in texts]


def seconds(work, times=3):
    def once():
        began = time.process_time()
        work()
        return time.process_time() - began
    return min(once() for _ in range(times))


def test_prose_is_scanned_several_times_as_fast_as_by_the_patterns_alone():
    rng = np.random.default_rng(23)
    words = ["".join(rng.choice(list("etaoinshrdlucmf"), rng.integers(2, 10))) for _ in range(2000)]
    texts = [" ".join(rng.choice(words, 500)) for _ in range(300)]
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    patterns = (assign, re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]{32,}"), re.compile("[A-Za-z0-9+/_=-]{16,}"))
    by_patterns = seconds(lambda: [p.findall(t) for t in texts for p in patterns])
    assert seconds(lambda: [se.examples(t) for t in texts]) < by_patterns / 3


def test_a_text_of_many_findings_costs_no_more_than_many_texts():
    rng = np.random.default_rng(29)
    parts = [f'word {rng.bytes(10).hex()} token="{rng.bytes(9).hex()}" ' for _ in range(4000)]
    apart = ["".join(parts[k:k + 50]) for k in range(0, len(parts), 50)]
    whole = "".join(parts)
    assert sum(y for y, _ in se.examples(whole)) == sum(y for t in apart for y, _ in se.examples(t)) == 8000
    assert seconds(lambda: se.examples(whole), 1) < 3 * seconds(lambda: [se.examples(t) for t in apart], 1) + 0.2


def plain_trained(state, candidates, y, share, seed, rate=0.01):
    """The steps as stated, each sum element by element."""
    rng = np.random.default_rng(seed)
    state = state.copy()
    p, m, v = (se.arrays(state[i * se.SIZE:(i + 1) * se.SIZE]) for i in range(3))
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))

    def hidden(rows):
        act = np.maximum(p[1] + sum(p[0][j][rows[:, j:44 + j]] for j in range(5)), 0)
        return act, np.concatenate([act.mean(1), act.max(1)], axis=1)

    for _ in range(se.PASSES):
        order = rng.permutation(len(candidates))
        for b in range(0, len(candidates), 128):
            i = order[b:b + 128]
            rows = np.concatenate([candidates[j] for j in i])
            logits = np.concatenate([hidden(rows[k:k + 512])[1] @ p[2] + float(p[3][0]) for k in range(0, len(rows), 512)])
            ends = np.cumsum([len(candidates[j]) for j in i])
            x = np.stack([candidates[j][g.argmax()] for j, g in zip(i, np.split(logits, ends[:-1]))])
            act, h = hidden(x)
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3][0], -40, 40))) - y[i]) * weight[i] / len(i)
            dh = d[:, None] * p[2]
            da = np.repeat(dh[:, None, :16] / 44, 44, axis=1)
            at = act.argmax(1)[:, None]
            np.put_along_axis(da, at, np.take_along_axis(da, at, 1) + dh[:, None, 16:], 1)
            da *= act > 0
            gf = np.zeros_like(p[0])
            for j in range(5):
                np.add.at(gf[j], x[:, j:44 + j], da)
            state[-1] += 1
            for a, g, mm, vv in zip(p, [gf, da.sum((0, 1)), h.T @ d, np.array([d.sum()])], m, v):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                a -= rate * (mm / (1 - 0.9 ** state[-1])) / (np.sqrt(vv / (1 - 0.999 ** state[-1])) + 1e-8)
    return state


def test_training_equals_the_plain_steps_and_is_faster():
    rng = np.random.default_rng(31)
    # rows a candidate: mostly one or two, some many, so that batches of over 512 rows come too; equal rows are ties
    for rows, n, times in (((1, 3), 1500, 3), ((1, 12), 300, 1)):
        candidates = [np.repeat(rng.integers(0, 20, (1, 48)), k, 0) if k % 3 == 0 else rng.integers(0, 20, (k, 48))
                      for k in rng.integers(*rows, n)]
        candidates = [c.astype(np.int16) for c in candidates]
        y = (rng.random(n) < 0.3).astype(int)
        for c, label in zip(candidates, y):
            c[:, 10:30] = c[:, 10:30] // 2 * 2 + label
        args = (candidates, y, 0.3, [7, 1, 2])
        begin = se.trained(se.untrained(), *args)
        assert np.array_equal(se.trained(begin, *args), plain_trained(begin, *args))
        if times > 1:
            assert seconds(lambda: se.trained(begin, *args), times) < 0.6 * seconds(lambda: plain_trained(begin, *args), times)
