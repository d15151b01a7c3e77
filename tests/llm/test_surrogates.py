import random
import re

import pytest

from rowgate.llm.queries import QUERIES
from rowgate.llm.surrogates import draw, luhn_valid, pseudonymize

from llm_cases import SMALL, edge_rows

FOUND = re.compile(r"[\w.+-]+@[\w.-]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])|\b4\d{15}\b")


def replaced(spark, area, *texts, key="k"):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pseudonymize(docs, key, area).orderBy("doc_id").collect()
    return [r.text for r in rows]


def luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def test_query_replaces_every_planted_value(spark, small):
    rows = {r.doc_id: r for r in QUERIES["op2_surrogates"](spark, SMALL).collect()}
    assert len(rows) == len(small)
    pairs, hits = {}, 0
    for doc_id, text, _ in small:
        real, new = FOUND.findall(text), FOUND.findall(rows[doc_id].text)
        if not real:
            assert rows[doc_id].text == text and rows[doc_id].surrogates == []
            continue
        hits += 1
        assert len(real) == len(new) and FOUND.split(text) == FOUND.split(rows[doc_id].text)
        for a, b in zip(real, new):
            assert a != b and pairs.setdefault(a, b) == b
            assert not b.isdigit() or luhn(b)
    assert hits and len(set(pairs.values())) == len(pairs) and not set(pairs) & set(pairs.values())


def test_formats_and_coreference(spark, area):
    text = "call (415) 555-2671, 415-555-2671 or +1 415 555 2671; pay 4111 1111 1111 1111 = 4111111111111111; 123-45-6789; A.b@Foo.com = a.b@foo.com"
    (new,) = replaced(spark, area, text)
    a, b, c = re.findall(r"[+(]?[\d][\d() -]{9,}\d", new)[:3]
    digits = [re.sub(r"\D", "", x) for x in (a, b, c)]
    assert digits[0] == digits[1] == digits[2][1:] != "4155552671" and digits[2][0] == "1"
    spaced, tight = re.search(r"pay (\d{4} \d{4} \d{4} \d{4}) = (\d{16})", new).groups()
    assert spaced.replace(" ", "") == tight != "4111111111111111" and luhn(tight)
    assert re.search(r"; \d{3}-\d{2}-\d{4}; ", new) and "123-45-6789" not in new
    left, right = re.findall(r"\S+@\S+", new)
    assert left == right and re.fullmatch(r"[a-z]\.[a-z]@[a-z]+\.example\.(com|net|org)", left)


def test_names_keep_family_gender_and_script(spark, area):
    text = "Mrs. Maria Rossi, Mr Rossi and Dr. ROSSI met Herr Jürgen Groß. Госпожа Анна Петрова"
    (new,) = replaced(spark, area, text)
    given, family = re.match(r"Mrs\. (\w+) (\w+), ", new).groups()
    assert given.endswith(("ina", "ela", "ora", "issa")) and f"Mr {family} and Dr. {family.upper()} met Herr " in new
    assert not any(name in new for name in ("Maria", "Rossi", "ROSSI", "Jürgen", "Groß", "Анна", "Петрова"))
    assert re.search(r"Госпожа [А-Я][а-я]+(ина|ела|ора|иса) [А-Я][а-я]+$", new)


def test_whole_names_go(spark, area):
    cases = [
        ("met Prof. Dr. Anna Schmidt today", ("Anna", "Schmidt")),
        ("met Herr Dr. Müller today", ("Müller",)),
        ("met Señor Gabriel García Márquez today", ("Gabriel", "García", "Márquez")),
        ("met Mr John Fitzgerald Kennedy today", ("John", "Fitzgerald", "Kennedy")),
        ("met Mrs Smith-Jones today", ("Smith", "Jones")),
        ("met Dr. J. Smith today", ("J.", "Smith")),
        ("met Mr O'Brien today", ("O'", "Brien")),
        ("met Frau Eva von der Leyen today", ("Eva", "Leyen")),
        ("met Mr John Smith today. Smith left, John Smith's dog and SMITH too", ("John", "Smith", "SMITH")),
    ]
    for (text, gone), new in zip(cases, replaced(spark, area, *(text for text, _ in cases))):
        assert not any(name in new for name in gone) and " today" in new
        title = re.match(r"met (?:(?:Prof|Dr|Mrs?|Herr|Señor|Frau)\.? )+", text)[0]
        assert new.startswith(title) and len(new.split()) == len(text.split())


def test_names_without_a_title_keep_their_surrogate(spark, area):
    texts = ("Smith came. Mr John Smith spoke; Smith and John Smith smith Jones", "Smith came with Jones", "Mr Smith came")
    new, untitled, _ = replaced(spark, area, *texts)
    family = new.split()[0]
    given = re.search(rf"Mr (\w+) {family} spoke", new)[1]
    assert new == f"{family} came. Mr {given} {family} spoke; {family} and {given} {family} smith Jones"
    assert untitled == "Smith came with Jones"


def test_national_phone_numbers_go(spark, area):
    phones = [
        "+1 415 555 2671", "415 555 2671", "4155552671", "1-415-555-2671", "1 (415) 555-2671", "1-800-555-1234", "030 12345678",
        "0171/1234567", "01 42 68 53 00", "01.42.68.53.00", "(+49) 30 1234567", "+49 30 1234567", "(030) 12345678", "01711234567",
    ]
    stay = ["on 01 02 2024 10:30", "on 01/02/2024", "at 1700000000", "0.4155552671", "05-06-2023 12 of 30"]
    new = replaced(spark, area, *(f"call {p} now" for p in phones), *stay)
    assert new[len(phones) :] == stay
    digits = [re.sub(r"\D", "", x) for x in new]
    for old, text in zip(phones, new):
        assert text != f"call {old} now" and re.sub(r"\d", "9", text) == re.sub(r"\d", "9", f"call {old} now")
        assert not old.startswith("0") or text.startswith("call 0")
    assert digits[0][1:] == digits[1] == digits[2] == digits[3][1:] == digits[4][1:]
    assert digits[8] == digits[9] and digits[10] == digits[11] and digits[6] == digits[12]


def test_lookalikes_stay(spark, area):
    texts = ["no 4111111111111112, ean 2390409500648, v1.2.3.4, 1.2.3.4.5, 300.1.1.1", "Version 2.0. of 3-4", "Mr. no name", "a@b", "10:30-11:00 2024-01-05"]
    assert replaced(spark, area, *texts) == texts


def test_another_key_gives_other_surrogates(spark, area):
    (a,), (b,), (c,) = (replaced(spark, area, "x@y.de 10.1.2.3", key=k) for k in ("k", "k", "other"))
    assert a == b != c


def test_edge_rows_stay_and_keep_their_columns(spark, edge, empty, area):
    result = pseudonymize(edge, "k", area)
    assert result.columns == [*edge.columns, "surrogates"]
    assert sorted(((r.doc_id, r.text, r.source) for r in result.collect()), key=str) == sorted(edge_rows(), key=str)
    assert pseudonymize(empty, "k", area).count() == 0


def test_repeated_rows_null_ids_and_many_entities(spark, area):
    many = " ".join(f"u{i}@h{i}.de" for i in range(500))
    rows = [(None, "x@y.de"), (None, "x@y.de"), (1, "x@y.de"), (1, many), (1, None), (2, "x@y.de\n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = pseudonymize(docs, "k", area).collect()
    assert len(found) == 6
    one = {r.text.strip() for r in found if r.text and len(r.text) < 99}
    assert len(one) == 1 and "x@y.de" not in one
    new = next(r for r in found if r.text and len(r.text) > 99)
    assert len(set(new.text.split())) == 500 == len(new.surrogates)


def test_a_crowded_type_stays_distinct(spark, area):
    """Single-letter local parts have 26 shapes: most values must draw again."""
    values = [("email", f"{c}@same.de") for c in "abcdefghijklmnopqrstuvwxyz"]
    values += [("given female latin", f"name{i}") for i in range(3000)]
    drawn = draw(spark.createDataFrame(values, "kind string, canonical string"), "k", area).collect()
    assert len({(r.kind, r.drawn) for r in drawn}) == len(values) == len(drawn)


def test_a_real_value_is_never_a_surrogate(spark, area):
    values = spark.createDataFrame([("ip", "9.9.9.9")], "kind string, canonical string")
    first = draw(values, "k", area).collect()[0].drawn
    both = spark.createDataFrame([("ip", "9.9.9.9"), ("ip", first)], "kind string, canonical string")
    assert not {r.drawn for r in draw(both, "k", area).collect()} & {"9.9.9.9", first}


@pytest.mark.parametrize("digits", ["4111111111111111", "378282246310005", "4111111111111112", "0", "79927398713"])
def test_check_digit(spark, digits):
    from pyspark.sql import functions as F

    assert spark.range(1).select(luhn_valid(F.lit(digits)).alias("v")).first().v == luhn(digits)


def test_no_python_runs(spark, edge, area):
    plan = pseudonymize(edge, "k", area)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_person_has_one_name_whatever_the_title(spark, area):
    text = "Dr. John Smith wrote. Later Mr John Smith left. John waved to Prof. John Smith."
    (new,) = replaced(spark, area, text)
    given, family = re.match(r"Dr\. (\w+) (\w+) wrote", new).groups()
    assert new == text.replace("John", given).replace("Smith", family)
    assert given.endswith(("ton", "rik", "mar", "bert"))


def test_planted_people_of_many_titles_agree_with_a_list(spark, area):
    """Every mention of a name in a text becomes the same one, other names others, in all texts."""
    rng = random.Random(4)
    men, women = ["John", "Karl", "Pedro", "Igor"], ["Anna", "Maria", "Clara", "Edith"]
    families = [f"{a}{b}" for a in ("Berg", "Stein", "Wald", "Rosen", "Linden") for b in ("er", "mann", "feld")]
    texts = []
    for _ in range(40):
        own, people = rng.sample(families, 3), rng.sample([(g, "Mr") for g in men] + [(g, "Mrs") for g in women], 3)
        mentions = []
        for (given, title), family in zip(people, own):
            forms = [f"Dr. {given} {family}", f"{title} {given} {family}", f"{title} {family}", f"Prof. {given} {family}"]
            bare = [given, family, f"{given} {family}"]
            mentions += [f"Dr. {given} {family}", *rng.sample(forms, 2), *rng.choices(bare, k=3)]
        first, rest = mentions[::6], [m for i, m in enumerate(mentions) if i % 6]
        rng.shuffle(rest)
        texts.append(" then ".join([*first, *rest]))
    real = {*men, *women, *families}
    given_of: dict[tuple[str, bool], set[str]] = {}
    for text, new in zip(texts, replaced(spark, area, *texts)):
        pairs = {}
        assert len(text.split()) == len(new.split())
        for a, b in zip(text.split(), new.split()):
            assert (a != b) == (a in real) and pairs.setdefault(a, b) == b
        names = {a: b for a, b in pairs.items() if a in real}
        assert len(set(names.values())) == len(names) and not set(names.values()) & real
        for a, b in names.items():
            if a in families:
                given_of.setdefault((a, True), set()).add(b)
            elif f"Mr {a}" in text:
                assert b.endswith(("ton", "rik", "mar", "bert"))
            elif f"Mrs {a}" in text:
                assert b.endswith(("ina", "ela", "ora", "issa"))
    assert all(len(drawn) == 1 for drawn in given_of.values())


def test_persons_beside_columns_of_clashing_names(spark, edge, area):
    from pyspark.sql import functions as F

    rows = edge.withColumn("text", F.concat(F.lit("Mr John Smith met "), F.coalesce("text", F.lit("no one"))))
    found = pseudonymize(rows, "k", area)
    assert found.columns == [*edge.columns, "surrogates"] and found.count() == edge.count()
    assert found.where(F.col("text").contains("Smith")).isEmpty()


def test_a_very_long_text_of_many_names(spark, area):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"X{letters[i // 26 // 26 % 26]}{letters[i // 26 % 26]}{letters[i % 26]}son" for i in range(2000)]
    text = " and ".join(f"Mr {n}" for n in names) + " but " + " or ".join(names)
    (new,) = replaced(spark, area, text)
    first, again = new.split(" but ")
    drawn = first.removeprefix("Mr ").split(" and Mr ")
    assert again.split(" or ") == drawn and len(set(drawn)) == 2000 and not set(drawn) & set(names)
