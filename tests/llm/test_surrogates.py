import re

import pytest

from ratelattice.llm import surrogates

from .tinydocs import ODD, documents

KEY = b"k1"
TEXT = (
    'Mail Ann.Lee42@mail8.example.com or call +1 (386) 555-3733, also 386-555-3733. Card 4111 1111 1111 1111, host 61.131.143.218, '
    'token = "0641917ea4e9feb9cda8", ssn 123-45-6789. Mrs. Ada Lovelace met Mr Lovelace and Господин Иванов.'
)


def test_formats_genders_and_scripts():
    made, spans = surrogates.replaced(TEXT, KEY, {})
    kinds = [k for _, _, k in spans]
    assert kinds == ["email", "phone", "phone", "card", "ipv4", "secret", "ssn", "given-f", "surname", "surname", "surname"]
    parts = [made[a:b] for a, b, _ in spans]
    assert re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z][a-z]{2}\d\d@[a-z]{4}\d\.[a-z]{7}\.com", parts[0]) and parts[0] != "Ann.Lee42@mail8.example.com"
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", parts[1]) and re.sub(r"\D", "", parts[1])[1:] == re.sub(r"\D", "", parts[2])
    assert re.fullmatch(r"4\d{3}( \d{4}){3}", parts[3]) and surrogates.luhn(parts[3].replace(" ", ""))
    assert all(0 <= int(o) <= 255 for o in parts[4].split("."))
    assert re.fullmatch(r"[0-9a-f]{20}", parts[5]) and re.fullmatch(r"\d{3}-\d\d-\d{4}", parts[6])
    assert parts[7].endswith("a") and parts[8] == parts[9] and surrogates.script_of(parts[10].lower()) == "cyrillic"
    assert surrogates.replaced(TEXT, KEY, {}) == (made, spans) and surrogates.replaced(TEXT, b"k2", {})[0] != made
    assert re.sub(r"[^ ]", "", made) == re.sub(r"[^ ]", "", TEXT)


def test_permutation_is_one_to_one():
    for alphabet, n in (("0123456789", 3), ("abcd", 4), ("0123456789", 1)):
        import itertools

        values = ["".join(v) for v in itertools.product(alphabet, repeat=n)]
        assert sorted(surrogates.permuted(v, alphabet, KEY, "t") for v in values) == values


def test_distinct_entities_stay_distinct_and_shared(spark, monkeypatch):
    real = surrogates.surrogate
    # at the first attempt all names collide
    monkeypatch.setattr(surrogates, "surrogate", lambda kind, value, key, attempt=0: "same" if kind == "surname" and not attempt else real(kind, value, key, attempt))
    names = ["Alpha", "Beta", "Gamma", "Delta", "Epsilon"]
    rows = [(i, f"Mr {names[i % 5]} wrote. Then Dr. {names[(i + 1) % 5]} came.") for i in range(20)] + [r for r in ODD if r[0] != 106]
    got = surrogates.pseudonymise(documents(spark, rows), KEY).collect()
    by_id = {r.doc_id: r for r in got}
    mapped = {}
    for i in range(20):
        row = by_id[i]
        for (start, end), name in zip([(s.start, s.end) for s in row.spans], (names[i % 5], names[(i + 1) % 5]), strict=True):
            assert mapped.setdefault(name, row.text[start:end]) == row.text[start:end]
    assert len(set(mapped.values())) == 5 and len(got) == len(rows)
    assert by_id[100].text is None and by_id[101].text == "" and by_id[104].text == "one two"


def test_empty_table_and_no_entity(spark):
    assert surrogates.pseudonymise(documents(spark, []), KEY).collect() == []
    got = surrogates.pseudonymise(documents(spark, [(1, "nothing here")]), KEY).collect()
    assert [(r.text, r.n_entities) for r in got] == [("nothing here", 0)]


@pytest.mark.parametrize("text", ["12345", "version 1.2.3.4.5", "4111 1111 1111 1112", "a@b", "2024-01-02", "Mr smith"])
def test_no_entities(text):
    assert surrogates.find_entities(text) == []


def words_left(text):
    made, spans = surrogates.replaced(text, KEY, {})
    return set(re.findall(r"\w+", made)), made, spans


@pytest.mark.parametrize(
    "text, hidden",
    [
        ("Mr John Michael Smith came", "John Michael Smith"),
        ("Herr Ludwig van Beethoven spielt", "Ludwig Beethoven"),
        ("we saw Mr John\nSmith there", "John Smith"),
        ("Dr. J. Robert Oppenheimer spoke. Later Oppenheimer's friend met Robert.", "Robert Oppenheimer"),
    ],
)
def test_whole_names_wherever_they_stand(text, hidden):
    left, made, _ = words_left(text)
    assert not left & set(hidden.split()) and len(made.split()) == len(text.split())


def test_recurring_names_keep_their_surrogate_and_other_words_stay():
    _, made, spans = words_left("Mr Smith\nThe end of the day. I saw Smith, and I left.")
    parts = [made[a:b] for a, b, _ in spans]
    assert len(parts) == 2 and parts[0] == parts[1] and made.replace(parts[0], "Smith") == "Mr Smith\nThe end of the day. I saw Smith, and I left."


@pytest.mark.parametrize(
    "secret",
    ["f" * 127 + "0a", "hunter2", "aGVsbG8+d29ybGQ/Zm9v==", "秘密の言葉", "correct horse battery"],
)
def test_secrets_of_any_alphabet_and_length(secret):
    _, made, spans = words_left(f'{{"client_secret": "{secret}", "n": 1}}')
    assert [k for *_, k in spans] == ["secret"] and secret not in made and made.endswith('", "n": 1}')
    assert surrogates.find_entities("The secret: patience.") == [] and surrogates.find_entities("password: patience")
    assert surrogates.find_entities("x?a=1&token=Ab9z&b=2")[0][:2] == (12, 16)


@pytest.mark.parametrize("text", ["+4915112345678", "+49 151 1234 5678", "٣٨٦-٥٥٥-٣٧٣٣", "日本@例え.jp", "_@-.com"])
def test_numbers_and_addresses_of_any_script_change(text):
    _, made, spans = words_left(f"see {text} there")
    assert len(spans) == 1 and made != f"see {text} there"


def test_addresses_outside_the_alphabets_are_settled(spark):
    rows = [(1, "日本@例え.jp"), (2, "_@-.com"), (3, "日@例.jp or password=a")]
    got = {r.doc_id: r.text for r in surrogates.pseudonymise(documents(spark, rows), KEY).collect()}
    assert len(got) == 3 and all(got[i] != t for i, t in rows)
