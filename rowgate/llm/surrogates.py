"""Replace personal data by keyed surrogates of the same type, native expressions only.

Entities are found by pattern: mail addresses, IPv4 addresses, payment cards (checked digit
included), social security and phone numbers, and persons introduced by one title or several,
with initials, particles and any number of names, the last of which is the family name. Names of
such a person are found again without a title wherever the same text has them with a capital;
initials become other letters, by the key alone. Each distinct
value gets a surrogate from a keyed hash: the same value gets the same one everywhere, whatever
its letter case or separators; a family name keeps its surrogate with any title or given name;
cards stay valid, numbers keep their separators, addresses go to reserved domains, names keep
their script, their letter case and the gender that the title tells.

Surrogates are checked against each other and against all values found: where two values of a
type would share one, or one is somebody's real value, the later value draws again. What is
shuffled are distinct values and the texts that have one; all other texts stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StagingArea
from .common import column, fresh

# Titles by the gender they tell.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Lord", "Sir", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Lady", "Госпожа")
NEUTRAL = ("Dr", "Prof")
TITLES = (*MALE, *FEMALE, *NEUTRAL)

#: Between given and family names; the words stay.
PARTICLES = ("von und zu", "von der", "von dem", "van der", "van den", "van de", "de la", "de las", "de los", "von", "van", "de", "del", "della", "di", "da", "do", "dos", "das", "du", "bin", "ibn", "ter", "ten", "y")
SUFFIXES = ("Jr", "Junior", "Senior", "II", "III", "IV", "PhD", "MD")

_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
_BLANK = r"[ \u00a0]"
_LETTER = r"[\p{L}\p{M}]"
_PARTICLE = "|".join(sorted(PARTICLES, key=len, reverse=True)).replace(" ", _BLANK)
_INITIAL = rf"(?:\p{{Lu}}\.-?)+|\p{{Lu}}(?!{_LETTER}|['’.])"
_NAME = (
    rf"(?!(?:{_TITLE}|{'|'.join(SUFFIXES)})(?!{_LETTER}))(?:\p{{L}}['’])?\p{{Lu}}{_LETTER}+"
    rf"(?:-{_LETTER}+|['’]\p{{Lu}}{_LETTER}+)*"
)
_NEXT = rf"(?:{_BLANK}(?:{_INITIAL}|(?:{_PARTICLE})(?!{_LETTER})))*{_BLANK}{_NAME}"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": r"(?<![\p{L}\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "card": r"(?<![\p{L}\d.-])(?:4\d{3}|5[1-5]\d{2}|2[2-7]\d{2}|6011|65\d{2}|35[2-8]\d)(?:[ -]?\d{4}){3}(?!\d)"
    r"|(?<![\p{L}\d.-])3[47]\d{2}[ -]?\d{6}[ -]?\d{5}(?!\d)",
    "ssn": r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    # With a country, also in brackets; 3-3-4 with or without a leading 1; ten digits; a leading 0, but no date.
    "phone": r"(?<![\p{L}\d])(?:\+\d{1,3}|\(\+\d{1,3}\))[ ./-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ ./-]?\d{2,4}){2,4}(?!\d)"
    r"|(?<![\p{L}\d(.-])(?:1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-]|[2-9]\d{2} )\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\p{L}\d(.,-])1?[2-9]\d{2}[2-9]\d{6}(?![\d-]|[.,]\d)"
    r"|(?<![\p{L}\d(.,/-])(?<!\d:)(?!\d\d[ /.-]\d\d[ /.-](?:19|20)\d\d(?!\d))(?=(?:[ /()-]{0,2}\d){9,15}(?!\d))"
    r"(?:0\d{1,4}[ /-]|\(0\d{1,4}\)[ /-]?)\d{2,10}(?:[ -]\d{1,5}){0,5}(?![\d:]|[.,]\d)"
    r"|(?<![\p{L}\d(.,/-])0[1-9](?:\.\d{2}){4}(?![\d.])"
    r"|(?<![\p{L}\d(.,/-])0{1,2}[1-9]\d{8,11}(?![\d-]|[.,]\d)",
    "person": rf"(?<![\p{{L}}\d])(?:{_TITLE})\.?(?:{_BLANK}(?:{_TITLE})\.?)*(?:{_NEXT})+",
}
ANY = "|".join(PATTERNS.values())
#: Sounds of made-up names by script, and how given names end.
SOUNDS = {
    "latin": ("ba de fi go hu ka le mi no ru sa te vi wo za lo", "ina ela ora issa", "ton rik mar bert"),
    "cyrillic": ("ба де фи го ху ка ле ми но ру са те ви во за ло", "ина ела ора иса", "тон рик мар берт"),
    "greek": ("μπα ντε φι γο χου κα λε μι νο ρου σα τε βι βο ζα λο", "ίνα έλα όρα ίσα", "τον ρικ μαρ νος"),
}
ROUNDS = 64


def _mayhave(text: Column) -> Column:
    """A cheap test that every text with an entity passes."""
    found = text.rlike("[0-9@]")
    for title in TITLES:
        found = found | F.contains(text, F.lit(title))
    return F.coalesce(found, F.lit(False))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def luhn_valid(digits: Column) -> Column:
    """Whether the last digit is the check digit of the others."""
    return _luhn_sum(digits) % 10 == 0


def _luhn_sum(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def weighed(place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        doubled = (F.length(digits) - place) % 2 == 1
        twice = digit * 2
        return F.when(doubled, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def _kind(entity: Column) -> Column:
    """The type of an entity; null where the shape is there but the value cannot be one."""
    def whole(name: str) -> Column:
        return entity.rlike(f"^(?:{PATTERNS[name]})$")

    card = whole("card")
    return (
        F.when(F.contains(entity, F.lit("@")), F.lit("email"))
        .when(entity.rlike(r"^\p{L}"), F.lit("person"))
        .when(whole("ip"), F.lit("ip"))
        .when(card & luhn_valid(_digits(entity)), F.lit("card"))
        .when(card, F.lit(None).cast("string"))
        .when(whole("ssn"), F.lit("ssn"))
        .otherwise(F.lit("phone"))
    )


def _script(word: Column) -> Column:
    return (
        F.when(word.rlike(r"^\p{IsCyrillic}"), F.lit("cyrillic"))
        .when(word.rlike(r"^\p{IsGreek}"), F.lit("greek"))
        .otherwise(F.lit("latin"))
    )


def _hash(key: str, *parts: Column) -> Column:
    """Keyed hash, 64 hex digits; nested, so that it cannot be prolonged."""
    message = F.concat_ws("\u0001", *parts)
    inner = F.sha2(F.concat(F.lit(f"{key}\u0002"), message), 256)
    return F.sha2(F.concat(F.lit(f"{key}\u0003"), inner), 256)


def _number(h: Column, at: int, digits: int) -> Column:
    """A decimal number from hex digits of a hash, with leading zeros."""
    value = F.conv(F.substring(h, at, 15), 16, 10).cast("bigint")
    return F.lpad((value % 10**digits).cast("string"), digits, "0")


def _pick(h: Column, at: int, words: str) -> Column:
    listed = words.split()
    place = F.conv(F.substring(h, at, 4), 16, 10).cast("int") % len(listed) + 1
    return F.element_at(F.array(*map(F.lit, listed)), place)


def surrogate(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """The canonical form of a surrogate, from the canonical form of a value."""
    h = _hash(key, kind, canonical, attempt.cast("string"))
    local, domain = F.substring_index(canonical, "@", 1), F.substring_index(canonical, "@", -1)
    d = _hash(key, F.lit("domain"), domain, attempt.cast("string"))

    def shaped(text: Column) -> Column:
        """Letters for letters, digits for digits, marks as they are."""
        stream = F.concat(h, F.sha2(h, 256))

        def one(place: Column) -> Column:
            c = F.substring(text, place, F.lit(1))
            value = F.conv(F.substring(stream, place * 2 % 124 + 1, F.lit(3)), 16, 10).cast("int")
            letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), value % 26 + 1, F.lit(1))
            return F.when(c.rlike(r"\p{N}"), (value % 10).cast("string")).when(c.rlike(r"\p{L}"), letter).otherwise(c)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), one), "")

    # A shape with few letters has few surrogates; later attempts make it longer.
    longer = F.when(attempt > 0, F.substring(F.translate(h, "0123456789", "ghijklmnop"), 1, 6)).otherwise("")
    email = F.concat(shaped(local), longer, F.lit("@"), F.translate(F.substring(d, 1, 8), "0123456789", "ghijklmnop"),
                     F.lit(".example."), F.element_at(F.array(F.lit("com"), F.lit("net"), F.lit("org")), F.conv(F.substring(d, 9, 2), 16, 10).cast("int") % 3 + 1))
    octet = [(F.conv(F.substring(h, 1 + 4 * i, 4), 16, 10).cast("int") % 254 + 1).cast("string") for i in range(4)]
    n = F.length(canonical)
    stream = F.concat(_number(h, 1, 15), _number(h, 16, 15))
    body = F.concat(F.substring(canonical, 1, 1), F.substring(stream, F.lit(1), n - 2))
    rest = _luhn_sum(F.concat(body, F.lit("0"))) % 10
    card = F.concat(body, ((10 - rest) % 10).cast("string"))
    # A leading + or 00 and its country stay, or a leading 0; then an area that does not start with 0 or 1.
    lead = F.regexp_extract(canonical, r"^(\+\d\d|00\d\d|0|)", 1)
    phone = F.concat(lead, (F.conv(F.substring(h, 60, 4), 16, 10).cast("int") % 8 + 2).cast("string"),
                     F.substring(stream, F.lit(1), n - F.length(lead) - 1))
    ssn = F.concat(F.lit("9"), F.substring(stream, 1, 8))  # numbers from 900 on are not given out
    names = None
    for script, (sounds, female, male) in SOUNDS.items():
        stem = F.concat(*(_pick(h, 1 + 4 * i, sounds) for i in range(3)))
        more = F.when(attempt > 0, F.concat(*(_pick(h, 17 + 4 * i, sounds) for i in range(2)))).otherwise("")
        ending = (
            F.when(F.startswith(kind, F.lit("given female")), _pick(h, 40, female))
            .when(F.startswith(kind, F.lit("given male")), _pick(h, 40, male))
            .otherwise(_pick(h, 40, sounds))
        )
        here = F.concat(stem, more, ending)
        matches = F.endswith(kind, F.lit(script))
        names = F.when(matches, here) if names is None else names.when(matches, here)
    return (
        F.when(kind == "email", email).when(kind == "ip", F.concat_ws(".", *octet)).when(kind == "card", card)
        .when(kind == "ssn", ssn).when(kind == "phone", phone).otherwise(names)
    )


def _canonical(kind: Column, part: Column) -> Column:
    """What all spellings of a value have in common."""
    return (
        F.when(kind.isin("card", "ssn"), _digits(part))
        .when(kind == "phone", F.regexp_replace(F.regexp_replace(part, r"[^0-9+]", ""), r"^\+1|^1(?=\d{10}$)", ""))
        .otherwise(F.lower(part))
    )


def _rendered(kind: Column, part: Column, drawn: Column) -> Column:
    """The surrogate in the spelling of the value it replaces."""
    digits = F.regexp_replace(drawn, r"^\+", "")
    plain = F.concat(F.when(F.length(_digits(part)) > F.length(digits), "1").otherwise(""), digits)

    def one(place: Column) -> Column:
        c = F.substring(part, place, F.lit(1))
        nth = F.length(_digits(F.substring(part, F.lit(1), place)))
        return F.when(c.rlike("[0-9]"), F.substring(plain, nth, F.lit(1))).otherwise(c)

    spaced = F.array_join(F.transform(F.sequence(F.lit(1), F.length(part)), one), "")
    upper = (F.length(part) > 1) & (part == F.upper(part))
    named = F.when(upper, F.upper(drawn)).otherwise(F.initcap(drawn))
    return F.when(kind.isin("card", "ssn", "phone"), spaced).when(kind.isin("email", "ip"), drawn).otherwise(named)


def _parts(found: DataFrame) -> DataFrame:
    """``key, pos, part, type, kind, surface, canonical`` of ``key, pos, entity`` rows.

    A person has a part for each word and blank; titles, particles and blanks have no kind.
    """
    typed = found.withColumn("type", _kind(F.col("entity")))
    words = F.when(F.col("type") == "person", F.split("entity", rf"(?<={_BLANK})|(?={_BLANK})")).otherwise(F.array("entity"))
    listed = typed.withColumn("words", words)

    def titled(titles: tuple[str, ...]) -> Column:
        return F.exists("words", lambda w: F.regexp_replace(w, r"\.$", "").isin(*titles))

    gender = F.when(titled(MALE), "male").when(titled(FEMALE), "female").otherwise("any")
    parts = listed.select(
        "key", "pos", "type", F.size("words").alias("n"), gender.alias("gender"), F.posexplode("words").alias("part", "surface")
    )
    surface = F.col("surface")
    stays = surface.rlike(rf"^(?:{_BLANK}|(?:{_TITLE})\.?)$") | surface.isin(*{w for p in PARTICLES for w in (*p.split(), "und")})
    name = F.when(F.col("part") < F.col("n") - 1, F.concat(F.lit("given "), F.col("gender"))).otherwise(F.lit("family"))
    kind = (
        F.when(F.col("type") != "person", F.col("type"))
        .when(F.col("type").isNull() | stays, F.lit(None).cast("string"))
        .when(surface.rlike(rf"^(?:{_INITIAL})$"), F.lit("initial"))
        .otherwise(F.concat_ws(" ", name, _script(surface)))
    )
    return parts.select("key", "pos", "part", "type", kind.alias("kind"), "surface").withColumn(
        "canonical", _canonical(F.col("kind"), surface)
    )


def named(docs: DataFrame) -> DataFrame:
    """``key, canonical, kind``: the names that each of the ``key, text`` rows has with a title.

    A word that is a family name and a given name in one text counts as the family name. A given
    name has one gender in a text: that of a title that tells it, else none.
    """
    pattern = F.lit(PATTERNS["person"])
    found = docs.select("key", F.posexplode(F.regexp_extract_all("text", pattern, F.lit(0))).alias("pos", "entity"))
    names = _parts(found).where("kind like 'family %' or kind like 'given %'")
    # Family names first, then the genders that titles tell.
    told = F.struct(F.col("kind").startswith("given any").alias("open"), "kind")
    return names.groupBy("key", "canonical").agg(F.min(told)["kind"].alias("kind"))


def own_patterns(names: DataFrame) -> DataFrame:
    """``key, pattern``: what finds all entities of a text and its own names without a title."""
    either = F.array_join(F.reverse(F.array_sort(F.collect_list(F.struct(F.length("canonical").alias("n"), "canonical")))["canonical"]), "|")
    one = F.concat(F.lit(r"(?=[\p{Lu}]|\p{L}['’]\p{Lu})(?iu:"), either, F.lit(rf")(?!{_LETTER}|\p{{N}})"))
    again = F.concat(F.lit(rf"{ANY}|(?<![\p{{L}}\p{{N}}])"), F.col("one"), F.lit(f"(?:{_BLANK}"), F.col("one"), F.lit(")*+"))
    return names.groupBy("key").agg(one.alias("one")).select("key", again.alias("pattern"))


def entities(docs: DataFrame, names: DataFrame) -> DataFrame:
    """``key, pos, part, type, kind, surface, canonical``: the parts of all entities of ``key, text, pattern`` rows.

    Names are of the one kind that they have in the text, with a title and without. Any entity but
    a person has one part. Parts without a kind stay as they are.
    """
    found = docs.select("key", F.posexplode(F.regexp_extract_all("text", F.col("pattern"), F.lit(0))).alias("pos", "entity"))
    titled = F.col("entity").rlike(f"^(?:{PATTERNS['person']})$")
    bare = (_kind(F.col("entity")) == "person") & ~titled
    known = names.select(F.col("key").alias("owner"), F.col("canonical").alias("name"), F.col("kind").alias("known"))
    own = F.col("key").eqNullSafe(F.col("owner")) & (F.col("canonical") == F.col("name"))

    def settled(persons: DataFrame, kind: Column) -> DataFrame:
        joined = _parts(persons).join(known, own, "left")
        return joined.select("key", "pos", "part", "type", kind.alias("kind"), "surface", "canonical")

    is_name = F.col("kind").startswith("family ") | F.col("kind").startswith("given ")
    others = _parts(found.where(F.coalesce(_kind(F.col("entity")) != "person", F.lit(True))))
    return (
        others.unionByName(settled(found.where(bare), F.col("known")))
        .unionByName(settled(found.where(titled), F.when(is_name, F.coalesce("known", "kind")).otherwise(F.col("kind"))))
    )


def other_initials(key: str, surface: Column) -> Column:
    """Initials with each letter replaced by another one of its script, by the key alone."""
    def one(c: Column) -> Column:
        moved = c
        for letters in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"):
            at = F.instr(F.lit(letters), c)
            step = F.conv(F.substring(_hash(key, F.lit("initial"), c), 1, 8), 16, 10).cast("bigint") % (len(letters) - 1)
            moved = F.when(at > 0, F.substring(F.lit(letters), ((at + step) % len(letters) + 1).cast("int"), F.lit(1))).otherwise(moved)
        return F.when(c.rlike(r"\p{L}") & (moved == c), F.lit("X")).otherwise(moved)

    return F.array_join(F.transform(F.split(surface, ""), one), "")


def draw(values: DataFrame, key: str, area: StagingArea) -> DataFrame:
    """``kind, canonical, drawn``: a surrogate of each distinct value, none equal to another or to a value.

    Values that draw a taken surrogate draw again; those that hold one keep it, so every
    round settles at least one value per surrogate. Rounds are written; what comes to the
    driver is whether any value is left.
    """
    real = values.select("kind", F.col("canonical").alias("drawn"), F.lit(True).alias("real"))
    current = area.stage(
        values.withColumn("attempt", F.lit(0)).withColumn("drawn", surrogate(key, F.col("kind"), F.col("canonical"), F.lit(0))),
        "drawn-0",
    )
    for attempt in range(1, ROUNDS + 1):
        owner = current.groupBy("kind", "drawn").agg(
            F.min(F.struct("attempt", "canonical")).alias("owner"), F.count(F.lit(1)).alias("claims")
        )
        taken = owner.join(real, ["kind", "drawn"], "left").where("claims > 1 or real")
        taken = area.stage(taken.select("kind", "drawn", "owner", F.coalesce("real", F.lit(False)).alias("real")), f"taken-{attempt}")
        if taken.isEmpty():
            return current.select("kind", "canonical", "drawn")
        again = F.coalesce(F.col("real") | (F.col("owner.canonical") != F.col("canonical")), F.lit(False))
        marked = current.join(taken, ["kind", "drawn"], "left").withColumn("again", again)
        n = F.when(F.col("again"), F.col("attempt") + 1).otherwise(F.col("attempt"))
        redrawn = marked.select("kind", "canonical", n.alias("attempt"), "again", "drawn").withColumn(
            "drawn", F.when(F.col("again"), surrogate(key, F.col("kind"), F.col("canonical"), F.col("attempt"))).otherwise(F.col("drawn"))
        )
        current = area.stage(redrawn.select("kind", "canonical", "attempt", "drawn"), f"drawn-{attempt}")
    raise RuntimeError(f"surrogates still collide after {ROUNDS} rounds")


def pseudonymize(docs: DataFrame, key: str, area: StagingArea, text: str = "text", doc_id: str = "doc_id", into: str = "surrogates") -> DataFrame:
    """The documents with all personal data in ``text`` replaced, and a column ``into``.

    ``into`` lists ``type, surrogate`` of each replaced entity in text order, empty where none
    is. Null and empty texts stay as they are, and so does every text without an entity, to the
    byte. Rows that repeat each other are replaced alike; a null id is an id like any other. All
    other columns are kept, whatever their names; an empty table gives an empty one.
    """
    own, hashed, mine, new, spans, searcher = (
        fresh(docs, n) for n in ("text_key", "text_sha", "found_key", "found_new", "found_spans", "found_pattern")
    )
    marked = docs.withColumn(hashed, F.when(_mayhave(column(text)), F.sha2(column(text), 256)))
    likely = marked.where(F.col(hashed).isNotNull())
    texts = likely.select(F.struct(column(doc_id).alias("id"), F.col(hashed).alias("sha")).alias("key"), column(text).alias("text"))
    titled = F.col("text").rlike(PATTERNS["person"])
    names = area.stage(named(texts.where(titled)), "names")
    patterns = area.stage(own_patterns(names), "patterns")
    keyed = patterns.select(F.col("key").alias("owner"), "pattern")
    persons = texts.where(titled).join(keyed, F.col("key").eqNullSafe(F.col("owner")), "left")
    searched = texts.where(~titled).withColumn("pattern", F.lit(ANY)).unionByName(
        persons.select("key", "text", F.coalesce("pattern", F.lit(ANY)).alias("pattern"))
    )
    parts = area.stage(entities(searched, names).distinct(), "entities")
    values = parts.where("kind is not null and kind <> 'initial'").select("kind", "canonical").distinct()
    drawn = area.stage(draw(area.stage(values, "values"), key, area), "surrogates")
    rendered = F.when(F.col("kind") == "initial", other_initials(key, F.col("surface"))).otherwise(
        F.coalesce(_rendered(F.col("kind"), F.col("surface"), F.col("drawn")), F.col("surface"))
    )
    replaced = parts.join(drawn, ["kind", "canonical"], "left").select("key", "pos", "part", "type", rendered.alias("new"))
    entity = replaced.groupBy("key", "pos").agg(
        F.max("type").alias("type"), F.array_sort(F.collect_list(F.struct("part", "new"))).alias("parts")
    ).select("key", F.struct("pos", "type", F.array_join(F.col("parts.new"), "").alias("surrogate")).alias("e"))
    listed = entity.groupBy("key").agg(F.array_sort(F.collect_list("e")).alias("found"))
    with_pattern = listed.join(keyed, F.col("key").eqNullSafe(F.col("owner")), "left")
    found = area.stage(with_pattern.select("key", "found", F.coalesce("pattern", F.lit(ANY)).alias("pattern")), "found")

    right = found.select(F.col("key").alias(mine), F.col("found.surrogate").alias(new), F.col("pattern").alias(searcher),
                         F.expr("transform(filter(found, e -> e.type is not null), e -> struct(e.type as type, e.surrogate as surrogate))").alias(spans))
    joined = likely.withColumn(own, F.struct(column(doc_id).alias("id"), F.col(hashed).alias("sha"))).join(
        right, F.col(own).eqNullSafe(F.col(mine)), "left"
    )
    between = F.split(column(text), F.coalesce(F.col(searcher), F.lit(ANY)), -1)
    last = F.element_at(between, -1)
    pieces = F.zip_with(F.slice(between, F.lit(1), F.size(between) - 1), F.col(new), lambda a, b: F.concat(a, b))
    rebuilt = F.when(F.col(new).isNull(), column(text)).otherwise(F.concat(F.array_join(pieces, ""), last))
    none = F.array().cast("array<struct<type:string,surrogate:string>>")

    def result(df: DataFrame, changed: Column, listed: Column) -> DataFrame:
        return df.select(*(changed.alias(c) if c == text else column(c) for c in docs.columns), listed.alias(into))

    return result(joined, rebuilt, F.coalesce(F.col(spans), none)).unionByName(
        result(marked.where(F.col(hashed).isNull()), column(text), none)
    )
