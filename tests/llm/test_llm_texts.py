"""Operators on single texts against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF001
from llm_cases import rows, table

from taxiframe.llm import fingerprints, host_rules, packing, pii, secrets, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark).cache()


@pytest.fixture(scope="module")
def given(spark):
    """The awkward rows and the texts of the smallest table."""
    more = spark.read.parquet(f"{SF001}/documents.parquet")
    return table(spark).select("doc_id", "text", "source").unionByName(more.select("doc_id", "text", "source")).cache()


def counted(frame):
    return Counter(tuple(r) for r in frame.collect())


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def brute_pii(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
                          ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                  "card": lambda d=digits: 16 <= len(d) <= 19 and luhn(d),
                  "phone": lambda d=digits: 8 <= len(d) <= 15}[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_base_spans(given):
    got = pii.digest(given)
    texts = given.select("doc_id", "text").collect()
    want = Counter()
    for r in texts:
        spans = brute_pii(r["text"] or "")
        n = Counter(k for k, _, _ in spans)
        want[(r["doc_id"], n["email"], n["ip"], n["card"], n["phone"], digest(spans))] += 1
    assert counted(got.drop("spans", "n_spans")) == want


@pytest.mark.parametrize("text", [
    "a@b.c@d.e", "1.2.3.4.5.6.7.8", "1 1 1", "+1 (2) 3", "x+12345678+1234567890", "a@b..c", "01.002.0003.255",
    "0000000256.1.1.1", "1.1.1.1111111111111111", "4111-1111-1111-1111 5500 0000 0000 0004", "@@a@b.c", "+123) 45678 ."])
def test_pii_of_hard_texts(text):
    assert [s for s in pii.expand(text) if s[0] in pii.BASE_KINDS] == brute_pii(text)


@pytest.mark.parametrize("cue", ["iban", "IBAN", "Iban", "IbAn", "iBAN no."])
def test_pii_cues_in_any_case(cue):
    assert pii.expand(f"\u0130\u00df {cue}: GB82 WEST 1234 5698 7654 32 x")[-1][0] == "account"


def test_pii_of_random_texts():
    rnd = np.random.default_rng(5)
    for _ in range(3000):
        text = "".join(rnd.choice(list("0125@.+- ()ab\n"), 40))
        assert [s for s in pii.expand(text) if s[0] in pii.BASE_KINDS] == brute_pii(text), text


def test_pii_method_adds_spans_and_redacts():
    text = "see https://bob:pw1@h/x, IBAN: GB82 WEST 1234 5698 7654 32, ssn 078-05-1120, iban GB82WEST12345698765433"
    spans = pii.expand(text)
    assert [(k, text[a:b]) for k, a, b in spans if k not in pii.BASE_KINDS] == [
        ("login", "bob:pw1"), ("account", "GB82 WEST 1234 5698 7654 32"), ("account", "078-05-1120")]
    assert "078" not in pii.redact(text, spans) and "<account>" in pii.redact(text, spans)


def brute_secrets(text):
    out = []
    for rank, (kind, pattern, group, least) in enumerate((
            ("assign", r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
                       r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?"
                       r"([A-Za-z0-9+/_.=-]+)", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [(k, a, b) for a, _, b, k in sorted(out)]


def test_secrets_base_spans(given, tmp_path):
    got = secrets.digest(secrets.update(given, str(tmp_path / "ledger")))
    want = Counter()
    for r in given.collect():
        spans = brute_secrets(r["text"] or "")
        n = Counter(k for k, _, _ in spans)
        want[(r["doc_id"], n["assign"], n["access"], n["hex"], digest(spans))] += 1
    assert counted(got.drop("spans")) == want


def test_secret_ledger_scans_only_what_is_new(spark, docs, tmp_path):
    ledger = str(tmp_path / "ledger")
    old = docs.where("doc_id < 10")
    secrets.update(old, ledger, rules=secrets.BASE_RULES).collect()
    blobs = old.select("text").fillna("").distinct().count()
    rows = secrets.read_ledger(spark, ledger)
    assert rows.count() == blobs
    secrets.update(old, ledger, rules=secrets.BASE_RULES).collect()
    assert secrets.read_ledger(spark, ledger).count() == blobs  # nothing is scanned again
    result = secrets.update(docs, ledger, rules=secrets.RULES)  # new blobs; new rules for the old ones
    again = [r["rules"] for r in secrets.read_ledger(spark, ledger).collect()]
    assert Counter(map(len, again))[2] == blobs
    fresh = secrets.update(docs, str(tmp_path / "other"), rules=secrets.RULES)
    assert counted(secrets.digest(result)) == counted(secrets.digest(fresh))
    assert result.columns == [*docs.columns, "secrets"]


def test_secrets_of_versions_reach_all_paths(spark, tmp_path):
    docs = spark.createDataFrame([("a", "x token=abcdef"), ("b", "x token=abcdef"), (None, "x token=abcdef"),
                                  ("a", "clean")], "path string, text string")
    got = secrets.update(docs, str(tmp_path / "l"), path="path").select("path", "text", "secrets.kind")
    assert counted(got.selectExpr("path", "text", "get(kind, 0)")) == Counter(
        [("a", "x token=abcdef", "assign"), ("b", "x token=abcdef", "assign"), (None, "x token=abcdef", "assign"),
         ("a", "clean", None)])


def brute_measures(text):
    words = WORD.findall(text)
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(wins)
    covered = {i + j for i, w in enumerate(wins) if n[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), len(lines))


def test_host_rule_measures(given):
    for r in given.collect():
        assert host_rules.measure_text(r["text"]) == brute_measures(r["text"] or "")


def test_host_verdicts(spark):
    good = " ".join(f"word{i}" for i in range(60))
    noisy = good + " # # # # # # # # #"
    data = [(i, noisy, "bad") for i in range(30)] + [(100, good, "bad"), (101, noisy, "fine"), (103, noisy, None)]
    data += [(200 + i, good, "fine") for i in range(30)] + [(300, "short", "fine"), (301, None, None)]
    data += [(400 + i, good + f" x{i}", f"h{i}") for i in range(10)]
    data += [(500 + i, noisy if i % 4 == 0 else good, "often") for i in range(80)]  # well above the mean, far below a half
    data += [(600 + i, noisy if i == 0 else good, "seldom") for i in range(80)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in host_rules.apply_rules(docs).collect()}
    assert not any(kept[i] for i in range(30)) and kept[100] and kept[101]
    assert not kept[300] and not kept[301] and all(kept[200 + i] for i in range(30))
    assert [kept[500 + i] for i in range(80)] == [i % 4 != 0 for i in range(80)]
    assert kept[101] and kept[103] and all(kept[600 + i] for i in range(80))


def test_host_rules_keep_columns_and_rows(docs):
    got = host_rules.apply_rules(docs)
    assert got.columns == [*docs.columns, "_quality", "base_failed", "kept"]
    again = host_rules.apply_rules(got)
    assert again.columns == [*got.columns, "__quality", "_base_failed", "_kept"]
    assert again.where("kept != _kept").count() == 0
    assert counted(got.select(docs.columns)) == counted(docs)
    assert host_rules.apply_rules(docs.limit(0)).count() == 0


def brute_tokens(scores, word):
    unknown = min(scores.values()) - token_counts.UNKNOWN
    best = [(0.0, 0)]
    token = token_counts.MARK + word
    for e in range(1, len(token) + 1):
        options = [(best[e - 1][0] + unknown, -(best[e - 1][1] - len(token[e - 1].encode())))]
        options += [(scores[token[s:e]] + best[s][0], best[s][1] - 1) for s in range(max(0, e - 20), e)
                    if token[s:e] in scores]
        options[0] = (options[0][0], best[e - 1][1] - len(token[e - 1].encode()))
        best.append(max(options))
    return -best[-1][1]


def test_token_counts(docs):
    scores = token_counts.piece_scores(token_counts.vocabulary())
    assert math.isclose(sum(math.exp(s) for s in scores.values()), 1.0, rel_tol=1e-6)
    got = counted(token_counts.count_tokens(docs).select("doc_id", "text", "tokens.n_pretokens", "tokens.n_tokens"))
    want = Counter()
    for r in docs.collect():
        words = WORD.findall(r["text"] or "")
        want[(r["doc_id"], r["text"], len(words), sum(brute_tokens(scores, w) for w in words))] += 1
    assert got == want
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


def test_trie_shares_and_forgets(monkeypatch):
    scores = token_counts.piece_scores(token_counts.vocabulary())
    monkeypatch.setattr(token_counts, "TERMINALS", 3)
    trie = token_counts.Trie(scores)
    for words in ({"ab", "abc"}, {"abcd", "b"}, {"ab", "zz", "z", "zzz"}):
        trie.add(words)
        assert all(trie.terminals[w] == brute_tokens(scores, w) for w in words)


def brute_fingerprint(text):
    import xxhash

    k, s = fingerprints.K, fingerprints.S
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    of_longs = lambda xs: __import__("functools").reduce(
        lambda seed, x: xxhash.xxh64_intdigest(x.to_bytes(8, "little", signed=True), seed), xs, 42)
    found = re.findall(r"[^\x20\x09-\x0D]{1,%d}" % fingerprints.LETTER, text)
    h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in found]
    picked = []
    if len(h) >= k:
        inner = [signed(of_longs(h[i:i + s])) for i in range(len(h) - s + 1)]
        for i in range(len(h) - k + 1):
            window = inner[i:i + k - s + 1]
            if min(window) in (window[0], window[-1]):
                picked.append(of_longs(window[::s]))
    if not picked:
        a = 0
        for x in h:
            a = signed(of_longs([a, x]))
        picked = [a % (1 << 64)] if h else []
    return "".join(f"{x:08x}" for x in sorted({p >> 32 for p in picked})[:fingerprints.SKETCH])


def brute_likeness(a, b):
    if a == b:
        return 1.0
    a, b = ({x[i:i + 8] for i in range(0, len(x), 8)} for x in (a, b))
    union = sorted(a | b)[:fingerprints.SKETCH]
    return len([x for x in union if x in a and x in b]) / len(union)


def test_edited_fingerprints(given):
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
                   round(r["near_edited"], 9), round(r["near_next"], 9))
                  for r in fingerprints.edited_likeness(given).collect())
    data = [(r["doc_id"], r["text"] or "") for r in given.collect()]
    name = lambda d: hashlib.md5(f"{'null' if d[0] is None else d[0]}:{d[1]}".encode()).digest()
    data.sort(key=lambda d: (d[0] is None, -(d[0] or 0), name(d)))
    prints = {t: brute_fingerprint(t) for _, t in data}
    want = Counter()
    for i, (doc_id, text) in enumerate(data):
        after = data[(i + 1) % len(data)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        fp, efp = prints[text], brute_fingerprint(edited)
        want[(doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp, efp,
              round(brute_likeness(fp, efp), 9), round(brute_likeness(fp, prints[after]), 9))] += 1
    assert got == want


def test_short_texts_have_fingerprints_of_their_own(spark):
    """Texts without a syncmer are not all alike."""
    rnd = np.random.default_rng(8)
    data = [(" ".join(f"w{x}" for x in rnd.integers(0, 1000, n)),) for n in range(1, 12) for _ in range(40)]
    got = {r["text"]: r["fingerprint"] for r in fingerprints.fingerprints(spark.createDataFrame(data, "text string")).collect()}
    assert all(got.values()) and len(set(got.values())) == len(got)
    assert all(got[t] == brute_fingerprint(t) for t in got)


def test_fingerprint_of_moved_passage(spark):
    shared = " ".join(f"w{i * i % 997}" for i in range(400))
    docs = spark.createDataFrame([("intro here " + shared,), (shared + " and an end",), ("other " * 3,)], "text string")
    a, b, c = (r["fingerprint"] for r in fingerprints.fingerprints(docs).collect())
    assert brute_likeness(a, b) > 0.9 and brute_likeness(a, c) == 0


def test_tokens_and_pieces(given):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.vocabulary())
    got = counted(packing.tokenize(given, size=64))
    want = Counter()
    for r in given.collect():
        ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(r["doc_id"], piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert got == want


def test_awkward_rows_are_awkward():
    texts = [r[1] for r in rows()]
    assert None in texts and "" in texts and max(len(t or "") for t in texts) > 20_000
    assert len(set(rows())) < len(rows())
