import random
import re

from cohortlens.llm import pii
from cohortlens.llm.pii import BASE_KINDS, find_pii, find_spans, luhn, mask, redact
from helpers import clash, documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text)
            if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def base(text):
    return [s for s in find_spans(text) if s[0] in BASE_KINDS]


def test_base_spans_equal_the_patterns_on_random_texts():
    rng = random.Random(5)
    bits = ["a", "é", "@", ".", "-", "1", "25", "255", "256", "4111111111111111", "4111 1111 1111 1111", " ", "+1",
            "(555)", "b.c", "@x.y", "1.2.3.4", "٣", "\n", "%", "_", "+", "9" * 15, "0"]
    for _ in range(6000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert base(text) == brute(text), repr(text)


def test_base_spans_equal_the_patterns_on_documents():
    import duckdb
    for (text,) in duckdb.execute("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall():
        assert base(text) == brute(text)


def test_added_kinds():
    text = ('IBAN: GB82 WEST 1234 5698 7654 32, bad IBAN GB00 WEST 1234 5698 7654 32; SSN 123-45-6789; '
            'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" https://me:pw@host.example/x account books')
    assert [text[s:e] for k, s, e in find_spans(text) if k not in BASE_KINDS] == [
        "GB82 WEST 1234 5698 7654 32", "123-45-6789", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff",
        "https://me:pw@host.example/x"]


def test_long_and_hostile_texts_are_quick():
    import time
    t0 = time.time()
    for text in ["9" * 300_000, "1." * 200_000, "a" * 300_000 + "@", "+1" * 100_000, "1 " * 200_000, "@a" * 200_000]:
        find_spans(text)
    assert time.time() - t0 < 20


def test_mask_unites_overlaps():
    assert mask("ab cd ef", [("email", 0, 4), ("ip", 3, 5), ("card", 6, 8)]) == "[EMAIL] [CARD]"
    assert mask(None, []) is None


def test_tables(spark):
    texts = [None, "", "mail me.at@x.example.com now", "mail me.at@x.example.com now"]
    docs = clash(documents(spark, texts, ids=[None, 1, 2, 2]), "spans", "kind")
    found = find_pii(docs).collect()
    assert sorted(len(r.spans) for r in found) == [0, 0, 1, 1]
    out = redact(docs, length_col="n_chars")
    assert out.columns == docs.columns
    assert sorted((str(r.text), str(r.n_chars)) for r in out.collect()) == [
        ("", "0"), ("None", "None"), ("mail [EMAIL] now", "16"), ("mail [EMAIL] now", "16")]
    assert find_pii(documents(spark, [])).count() == 0


def test_long_secrets_are_found_to_their_end():
    for secret in ("a1B2" * 100, ".".join(("eyJ0" * 30, "c3Vi" * 60, "s1-G_" * 20 + "9")), "Ab1/" * 50 + "7"):
        text = f"my token: {secret}. Then more"
        assert pii.find_spans(text) == [("account", 10, 10 + len(secret))]
        assert pii.mask(text, pii.find_spans(text)) == "my token: [ACCOUNT]. Then more"
    login = "https://" + "u" * 100 + ":" + "p4" * 200 + "@host.example.org/x"
    assert ("login", 4, 4 + len(login)) in pii.find_spans(f"see {login} there")


ACCOUNT = re.compile(pii._AFTER_CUE + r"([A-Za-z0-9][A-Za-z0-9_/+.-]*+)")


def plain_account(text):
    """Accounts after a cue, with the whole run matched again at every cue."""
    out, done = [], 0
    cues = sorted((m.end(), m.start()) for cue in pii.CUES["account"]
                  for form in {cue, cue.upper(), cue.capitalize(), cue.title()}
                  for m in re.finditer(f"(?=({re.escape(form)}))", text) for m in [re.compile(re.escape(form)).match(text, m.start())])
    for end, start in cues:
        if start < done or text[start - 1:start].isalnum():
            continue
        m = ACCOUNT.match(text, end)
        if not m or m.start(1) == end:
            continue
        value = m[1].rstrip("_/+.-")
        stop = m.start(1) + len(value)
        if len(value) >= 8 and sum("0" <= c <= "9" for c in value) >= 4 and text[stop:stop + 1] != "_" \
                and m.start(1) >= done:
            done = stop
            out.append(("account", m.start(1), stop))
    return out


def test_accounts_equal_a_plain_search_on_random_texts():
    rng = random.Random(8)
    bits = ["token", "Account", "acct", "-no.", " number ", "_id", ": ", "=", " is ", "a1b2", "12345678", "_", ".", "/",
            "x", " ", "'", "99", "compte", "é", "api key", "7-7"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 12)))
        assert [s for s in find_spans(text) if s[0] == "account"] == plain_account(text), repr(text)


def test_repeated_cues_are_quick():
    import time
    for text in ["token-no." * 100_000, '"token" no.' * 100_000, "token_no_" * 100_000, "token-no.a1" * 100_000,
                 "token=" + "account_" * 100_000 + "12345"]:
        t0 = time.time()
        find_spans(text)
        assert time.time() - t0 < 5, text[:20]
