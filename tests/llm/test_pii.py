import ipaddress
import re
import unicodedata
from itertools import product

import corpus_pipeline
import pytest
from aircascade.llm import pii, queries

from aircascade.llm.common import table

from .helpers import documents

KEY = b"k" * 32
TEXTS = [
    "Write to Jane.Doe@mail7.example.com or JANE.DOE@MAIL7.example.com, call +1 (017) 555-7713 or 017-555-7713.",
    "Host 97.51.17.173 and 97.51.17.174, card 4111 1111 1111 1111 and 4845168114407329 7536784127813050.",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" password: hunter2hunter2x ssn 123-45-6789',
    "Mr. Peter Müller met Frau Anna Schmidt and Herr Иван Петров. Mr. PETER MÜLLER left.",
    None, "", "nothing here 2.0 and 1999, v1.2.3 @ noon", "a" * 50000 + "@",
]


def test_permutation_without_fixed_points():
    for n in (2, 3, 10, 1000):
        p = [pii.permuted(i, n, KEY, "t") for i in range(n)]
        assert sorted(p) == list(range(n)) and all(a != b for a, b in enumerate(p))


def test_types_formats_and_coreference():
    new, said = pii.replaced(TEXTS[0], KEY)
    mail, loud, phone, short = (s for _, _, s in said)
    assert mail.lower() == loud.lower() and mail.endswith(".example.com") and loud.startswith(loud.split("@")[0].upper())
    assert phone.startswith("+1 (") and phone[-8:] == short[-8:] and "Doe" not in new and "7713" not in new
    _, said = pii.replaced(TEXTS[1], KEY)
    assert [k for k, *_ in said] == ["ip", "ip", "card", "card", "card"]
    for kind, old, new in said:
        if kind == "ip":
            ipaddress.IPv4Address(new)
        else:
            digits = lambda s: "".join(c for c in s if c.isdigit())
            assert old[0] == new[0] and len(old) == len(new)
            assert (pii._luhn(digits(old)[:-1]) == int(old[-1])) == (pii._luhn(digits(new)[:-1]) == int(new[-1]))
    new, said = pii.replaced(TEXTS[3], KEY)
    by = {old: s for _, old, s in said}
    assert by["Peter"] in pii.MALE and by["Anna"] in pii.FEMALE and by["Иван"] in pii.MALE_CYRILLIC and by["PETER"] == by["Peter"].upper()
    assert all("а" <= c <= "я" or c == "ё" for c in by["Петров"].lower())
    assert pii.replaced(TEXTS[6], KEY) == (TEXTS[6], [])


def test_rows(spark):
    out = pii.with_surrogates(documents(spark, TEXTS)).collect()
    assert [r.text is None for r in sorted(out, key=lambda r: r.doc_id)] == [t is None for t in TEXTS]
    assert sum(r.n_email for r in out) == 2 and sum(r.n_secret for r in out) == 2 and sum(r.n_ssn for r in out) == 1
    assert pii.collisions(documents(spark, TEXTS)).count() == 0
    assert pii.with_surrogates(documents(spark, [])).count() == 0
    other = pii.with_surrogates(documents(spark, TEXTS), key="another").collect()
    assert {r.text for r in other if r.n_email} != {r.text for r in out if r.n_email}


def test_distinct_entities_stay_distinct(spark):
    texts = [f"u{i}@host{i % 3}.example.com 10.0.{i % 256}.{i // 256} +1 (200) 555-{i:04d}" for i in range(2000)]
    docs = documents(spark, texts)
    assert pii.collisions(docs).count() == 0
    said = [m for r in pii.with_surrogates(docs, mentions=True).collect() for m in r.mentions]
    assert len({m.surrogate for m in said}) == len({m.entity for m in said})


def test_entities_are_replaced_to_their_end():
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiI0MiJ9.c2ln/bmF0+dXJl_w=="
    long_, hexa = "aZ3-" * 75, "0a1B" * 64
    for before, secret, after in (('token="', long_, '" x'), ("token=", jwt, ", x"), ("key ", hexa, " x"), ("password: ", "p4ss.w0rd(ключ)9", "\n"), ("api_key=", "q" * 20000, "")):
        new, said = pii.replaced(before + secret + after, KEY)
        assert [m[:2] for m in said] == [("secret", secret)] and new == before + said[0][2] + after
        assert len(said[0][2]) == len(secret) and not any(secret[i : i + 12] in new for i in range(len(secret) - 11)) and "ключ" not in new
    for name in ("Juan Carlos Perez", "John Q. Public", "J.R.R. Tolkien", "Vincent van Gogh", "Ana María de la Cruz Lopez"):
        for title in ("Mr.", "Dr", "Herr Prof. Dr."):
            new, said = pii.replaced(f"See {title} {name}. He left", KEY)
            left = [w for w in name.replace(".", " ").split() if w[0].isupper()]
            assert [m[1] for m in said] == left and new.startswith(f"See {title} ") and new.endswith(". He left")
            assert not any(len(w) > 1 and w in new for w in left)
    assert pii.replaced("Mr. Smith left. Ms. Jones\n\nNext", KEY)[0].endswith("\n\nNext")
    assert [m[0] for m in pii.replaced("at 10.02.03.04", KEY)[1]] == ["ip"]


def test_long_entities_are_permuted():
    texts = {f"{a}{'x' * 254}{b}{'7' * 300}{c}" for a in "abc" for b in "abc" for c in "abc"}
    new = {pii.surrogate("secret", t, KEY) for t in texts}
    assert len(new) == len(texts) and not new & texts
    # No part of a wide number is permuted as another part of it.
    n = pii.permuted(0, 1 << 1536, KEY, "t")
    left = n >> 768
    assert len({left >> k & ((1 << 256) - 1) for k in (0, 256, 512)}) == 3


def test_maps_of_one_format_have_disjoint_images(spark):
    pools = [pii.MALE, pii.FEMALE, pii.MALE_CYRILLIC, pii.FEMALE_CYRILLIC]
    assert len(pii.POOLS) == sum(map(len, pools))
    short = {"".join(x).capitalize() for x in product(pii.ROWS[0], pii.ROWS[1], pii.ROWS[0])}
    names = sorted(short | {n for pool in pools for n in pool})
    new = {n: pii.surrogate("name", n, KEY) for n in names}
    assert len(set(new.values())) == len(names) and all(a != b for a, b in new.items())
    assert all((a.lower() in pii.POOLS) == (b.lower() in pii.POOLS) for a, b in new.items())
    # One letter in three: of the letters g to z, some would become a to f.
    said = {x: pii.surrogate("secret", x, KEY) for i in range(500) for x in (f"{i:011d}a", f"{i:011d}z")}
    assert len(set(said.values())) == 1000 and all(pii._hexa(a) == pii._hexa(b) for a, b in said.items())
    assert all(pii._lower(c.upper()) == c for c in pii.ROW if len(c.upper()) == 1)
    assert pii.collisions(documents(spark, [f"Mr. {n}" for n in names])).count() == 0


def test_shared_surrogates_fail_the_query_and_the_pipeline(spark, tmp_path, monkeypatch):
    docs = documents(spark, TEXTS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op8_pii_surrogates(spark, str(tmp_path)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, pii.with_surrogates(docs.select("doc_id", "text")).collect()))
    assert [r.n_email for r in sorted(rows, key=lambda r: r.doc_id)] == [2, 0, 0, 0, 0, 0, 0, 0]
    pairs = [("name", 1, 2, 7, 8), ("name", 1, 2, 7, 8), ("ip", 1, 2, 7, 8), ("name", 1, 3, 7, 9)]
    schema = "type string, e1 long, e2 long, s1 long, s2 long"
    monkeypatch.setattr(pii, "_pairs", lambda *_: spark.createDataFrame(pairs, schema))
    assert pii.collisions(docs).count() == 0
    for other in (("name", 1, 3, 7, 8), ("name", 0, 2, 7, 8), ("name", 5, 6, 5, 6)):
        bad = [*pairs, other]
        monkeypatch.setattr(pii, "_pairs", lambda *_: spark.createDataFrame(bad, schema))  # noqa: B023
        with pytest.raises(ValueError, match="1 of type name"):
            queries.op8_pii_surrogates(spark, str(tmp_path))
        with pytest.raises(ValueError, match="1 of type name"):
            corpus_pipeline.replace_personal_data(spark, docs, "")


def test_every_letter_and_number_turns_within_its_script():
    letters = [c for c in map(chr, range(0x110000)) if unicodedata.category(c)[0] in "LN"]
    low = sorted({pii._lower(c) for c in letters if ord(c) < 0x3400 or ord(c) % 61 == 0})
    rows = {c: pii._row(c) for c in low}
    assert all(len(rows[c]) > 1 and c in rows[c] for c in low)
    assert all(pii._row(x) == rows[c] for c in low if c.isalpha() for x in rows[c][:3])  # rows are classes: all members name the same
    known = ("LATIN", "CYRILLIC", "GREEK", "ARMENIAN", "HEBREW", "ARABIC", "CJK", "HANGUL", "DEVANAGARI", "GEORGIAN")
    strays = [c for c in low if unicodedata.name(c, "").split(" ")[0] in known and len({unicodedata.name(x, "?").split(" ")[0] for x in rows[c]}) > 1]
    assert len(strays) < 60  # those without another of their class in their block
    for step in range(0, len(letters), 997):
        for kind, entity in (("name", letters[step]), ("email", letters[step] + "@mail.example.com")):
            new = pii.surrogate(kind, entity, KEY)
            assert pii.canonical(kind, new) != pii.canonical(kind, entity) and len(new) == len(entity)


def test_names_of_all_scripts_and_their_mentions():
    for name in ("Արմեն Պետրոսյան", "Ž", "Željko Šć", "Łukasz Žižka", "王伟", "राज कुमार", "שרה לוי", "ΣΟΦΙΑ Παππάς"):
        new, said = pii.replaced(f"Mr. {name}", KEY)
        assert len(said) == len(name.split()) and not set(name.split()) & set(new.split())
    new, said = pii.replaced("Dr. Who met Peter Smith. Smith's dog left. Ms. May Smith in may or May.", KEY)
    by = {old: s for _, old, s in said}
    assert "Smith" not in new and "Peter" not in new and by["Peter"] in pii.MALE and new.count(by["Smith"]) == 3 and f"{by['Smith']}'s dog" in new
    assert new.endswith("in may or May.")


def test_hosts_numbers_and_keys():
    said = lambda text: pii.replaced(text, KEY)[1]
    host = lambda text: said(text)[0][2].partition("@")[2]
    assert host("bob@mail.acmecorp.com").endswith("." + host("bob@acmecorp.com")) and "acmecorp" not in host("bob@mail.acmecorp.com")
    assert host("bob@acme.co.uk").endswith(".co.uk") and host("bob@co.uk") == "co.uk" and host("bob@a.example.com").endswith(".example.com")
    short = {f"{a}{b}.uk" for a in "abcdegmnoru" for b in "abcdegmnoru"} | {f"a.{x}.uk" for x in sorted(pii.SECOND_LEVEL)}
    new = {h: host(f"x@{h}") for h in short}
    assert len(set(new.values())) == len(short)
    for text in ("DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819"):
        ((kind, old, iban),) = said(f"to {text}.")
        bare = iban.replace(" ", "")
        assert (kind, old) == ("iban", text) and iban != text and iban[:2] == text[:2] and pii._mod97(bare[4:] + bare[:4]) == 1
    assert said("DE88 3704 0044 0532 0130 01") == [] or said("DE88 3704 0044 0532 0130 01")[0][0] != "iban"
    ((kind, _, ip),) = said("at 2001:db8::8a2e:370:7334, 12:30:45")
    assert kind == "ip" and ipaddress.IPv6Address(ip) and pii.canonical("ip", "2001:0db8:0:0:0:8a2e:370:7334") == "2001:db8::8a2e:370:7334"
    for phone in ("+44 20 7946 0958", "07700 900123", "+49 (0)30 123456", "+14155552671"):
        ((kind, old, new),) = said(f"call {phone}.")
        assert (kind, old) == ("phone", phone) and new != phone and re.sub("[0-9]", "0", new) == re.sub("[0-9]", "0", phone)
    for before, key, after in (("AKIA", "IOSFODNN7EXAMPLE", ""), ("ghp_", "abcdefghijklmnopqrstuvwxyz0123456789", " x"), ("-----BEGIN RSA PRIVATE KEY-----", "\nMIIEow==\n", "-----END RSA PRIVATE KEY-----")):
        ((kind, old, new),) = said(before + key + after)
        assert (kind, old) == ("secret", key) and new != key and len(new) == len(key)
    assert said("password: ************ ok") == [] and said("plain words, 2024-05-06 12:00:01, 3.14") == []


def test_documents_against_plain_patterns(spark):
    """Brute force: of all that plain patterns find in the given documents nothing is left, and all else is as it was."""
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    before = {r.doc_id: r.text for r in docs.collect()}
    out = {r.doc_id: r.text for r in queries.op8_pii_surrogates(spark, sf_dir).collect()}
    said = {r.doc_id: r.mentions for r in pii.with_surrogates(docs, mentions=True).collect()}
    plain = [r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+", r"\b\d{3}-\d{2}-\d{4}\b", r"\+\d \(\d{3}\) \d{3}-\d{4}", r"\b[0-9a-f]{40}\b", r"\b(?:\d{1,3}\.){3}\d{1,3}\b(?!\.\d)"]
    seen = 0
    for i, text in before.items():
        new, rest, at = [], text or "", 0
        for m in said[i]:
            k = rest.index(m.entity, at)
            new += [rest[at:k], m.surrogate]
            at = k + len(m.entity)
        assert (out[i] or "") == "".join(new) + rest[at:]
        for pattern in plain:
            for x in re.findall(pattern, text or ""):
                seen += 1
                assert x not in out[i]
    assert seen > 50


def test_null_and_repeated_ids(spark):
    docs = documents(spark, ["a@b.com", "a@b.com", None, "c@b.com"], [None, 3, 3, 3])
    rows = pii.checked_surrogates(docs).collect()
    assert sorted((r.doc_id is None, r.n_email) for r in rows) == [(False, 0), (False, 1), (False, 1), (True, 1)]
    assert len({r.text for r in rows if r.text}) == 2
