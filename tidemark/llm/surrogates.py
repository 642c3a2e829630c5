"""Personal data replaced by keyed surrogates of the same type and form.

Detected are e-mail addresses, hexadecimal secrets, IPv4 addresses, payment card numbers, social
security numbers, telephone numbers and names behind a title. Every distinct entity gets one
surrogate, drawn from a SHA-256 over a secret key, its type, its canonical form and a draw number,
so the same entity reads the same everywhere (coreference) and nothing can be traced without the
key. Canonical are the digits of card, social security and telephone numbers, and addresses and
secrets in lower case. A name has two parts: its last word is the family name, drawn alone, and a
given name is drawn for its family name and the title's gender, so 'Mr. John Smith' and 'Mr Smith'
share a family name. A telephone number with its country code is another one than without.

Layout is applied afterwards: separators, case and length stay; a card number stays valid or
invalid under its check digit; an address stays an address; a name keeps its title, and takes a
given name of the title's gender and both names of their script.

All surrogates are checked together in canonical form: one that equals another's or any entity
found in the texts is drawn again, entities settled in earlier draws keeping theirs, until all are
distinct; given names are distinct within a family name. Later draws of names grow longer, so their
supply does not end.

Defined results: null text stays null and empty text empty; repeated rows are replaced alike;
other columns are kept; texts without entities come back unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.columns import set_aside
from tidemark.session import materialize

# Titles by gender, and name parts by script and gender.
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа")
GIVEN = {
    ("latin", "male"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Max", "Noel", "Oscar", "Paul"),
    ("latin", "female"): ("Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Ida", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula"),
    ("cyrillic", "male"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Леонид", "Максим", "Никита", "Олег", "Павел", "Роман", "Сергей", "Юрий"),
    ("cyrillic", "female"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Ксения", "Лариса", "Мария", "Нина", "Ольга", "Полина", "Раиса", "Юлия"),
}
SYLLABLES = {
    "latin": ("ba", "de", "fi", "go", "ha", "ke", "li", "mo", "na", "pe", "ri", "so", "ta", "ve", "wi", "zo"),
    "cyrillic": ("ба", "ве", "ги", "до", "жа", "зе", "ки", "ло", "ма", "не", "пи", "ро", "са", "те", "фи", "хо"),
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Tried in this order at every place.
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"\b(?=[0-9A-Fa-f]*[A-Fa-f])(?=[0-9A-Fa-f]*\d)[0-9A-Fa-f]{32,64}\b",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\d.]*\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]*\d)",
    "card": r"(?<![\d-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?!\d)",
    "phone": r"(?<![\d(])(?:\+\d{1,3}[ -]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d+-])(?:\+\d{1,3}[ .-])?\d{3}[.-]\d{3}[.-]\d{4}(?!\d)",
    "name": rf"\b(?:{'|'.join(MALE + FEMALE)})\.? +\p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?",
}
ANY = "|".join(PATTERNS.values())
NUMBERS = ("card", "ssn", "phone")


def _kind(entity: Column) -> Column:
    """The first type whose pattern covers the whole entity."""
    kind = F.lit("name")
    for name in reversed(list(PATTERNS)[:-1]):
        whole = "^(?:" + PATTERNS[name] + ")$"
        kind = F.when(entity.rlike(whole), F.lit(name)).otherwise(kind)
    return kind


def _draw(key: str) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), F.col("part"), F.col("canon"), F.col("draw").cast("string")), 256)


def _number(at: Column, width: int = 2) -> Column:
    """A number from the digest ``d``, taken at hex digit ``at``."""
    return F.conv(F.substring(F.col("d"), (at % (64 - width)) + 1, F.lit(width)), 16, 10).cast("int")


def _pick(values: tuple[str, ...], at: int) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _number(F.lit(at)) % len(values) + 1)


def _reshaped(text: Column) -> Column:
    """Every digit and every Latin letter replaced by one of its own class."""

    def sign(c: Column, i: Column) -> Column:
        value = _number(i * 3)
        lower = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), value % 26 + 1, F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), F.when(i == 0, value % 9 + 1).otherwise(value % 10).cast("string"))
            .when(c.rlike(r"\p{Lu}"), F.upper(lower))
            .when(c.rlike(r"\p{L}"), lower)
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), sign), "")


def _check(digits: Column) -> Column:
    """Check sum of a card number, from its last digit; 0 for a valid one."""
    signs = F.reverse(F.split(F.regexp_replace(digits, r"\D", ""), ""))
    doubled = F.transform(
        signs, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1))
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10


def _card(entity: Column) -> Column:
    """New digits; the last one keeps a valid number valid and an invalid one invalid."""
    fresh = _reshaped(entity)
    stem = F.substring(fresh, F.lit(1), F.char_length(fresh) - 1)
    fitting = (10 - _check(F.concat(stem, F.lit("0")))) % 10
    last = F.when(_check(entity) == 0, fitting).otherwise((fitting + 1 + _number(F.lit(50)) % 9) % 10)
    return F.concat(stem, last.cast("string"))


def _longer(text: Column, parts: tuple[str, ...]) -> Column:
    """``text`` with one more syllable for every draw but the first."""
    more = F.transform(F.sequence(F.lit(1), F.col("draw")), lambda i: F.element_at(F.array(*[F.lit(p) for p in parts]), _number(i * 5 + 11) % 16 + 1))
    return F.when(F.col("draw") > 0, F.concat(text, F.array_join(more, ""))).otherwise(text)


def _family(script: str) -> Column:
    parts = SYLLABLES[script]
    return _longer(F.concat(F.initcap(_pick(parts, 4)), _pick(parts, 8), _pick(parts, 12)), parts)


def _given(script: str) -> Column:
    male = F.substring_index("canon", "\x1f", 1) == "male"
    return _longer(F.when(male, _pick(GIVEN[script, "male"], 0)).otherwise(_pick(GIVEN[script, "female"], 0)), SYLLABLES[script])


def _fresh() -> Column:
    """The canonical surrogate of ``canon``."""
    canon, part = F.col("canon"), F.col("part")
    octets = F.array_join(F.array(_number(F.lit(0)) % 223 + 1, *[_number(F.lit(i)) % 254 + 1 for i in (4, 8, 12)]).cast("array<string>"), ".")
    mail = F.concat(_reshaped(F.substring_index(canon, "@", 1)), F.lit("@mail"), F.substring(F.col("d"), F.lit(58), F.lit(6)), F.lit(".example.net"))
    # Of a given name, its own script decides.
    own = F.when(part == "given", F.element_at(F.split(canon, "\x1f"), 2)).otherwise(canon)
    cyrillic = own.rlike(r"\p{IsCyrillic}")
    return (
        F.when(part == "email", mail)
        .when(part == "secret", F.substring(F.col("d"), F.lit(1), F.char_length(canon)))
        .when(part == "ip", octets)
        .when(part == "card", _card(canon))
        .when(part == "family", F.when(cyrillic, _family("cyrillic")).otherwise(_family("latin")))
        .when(part == "given", F.when(cyrillic, _given("cyrillic")).otherwise(_given("latin")))
        .otherwise(_reshaped(canon))
    )


def _parts(entities: DataFrame) -> DataFrame:
    """Of every entity: part and canon to draw for, and for names of two words, canon and scope of the given name."""
    entity, kind = F.col("entity"), F.col("kind")
    family = F.lower(F.regexp_extract(entity, r"(\S+)$", 1))
    given = F.lower(F.regexp_extract(entity, r"^\S+ +(\S+) \S+$", 1))
    gender = F.when(F.regexp_replace(F.regexp_extract(entity, r"^(\S+) ", 1), r"\.", "").isin(*MALE), "male").otherwise("female")
    canon = F.when(kind.isin(*NUMBERS), F.regexp_replace(entity, r"\D", "")).when(kind == "name", family).otherwise(F.lower(entity))
    two = (kind == "name") & (given != "")
    return entities.select(
        "entity",
        "kind",
        F.when(kind == "name", "family").otherwise(kind).alias("part"),
        canon.alias("canon"),
        F.when(two, F.concat_ws("\x1f", gender, given, family)).alias("given"),
        F.when(two, F.concat_ws("\x1f", gender, family)).alias("scope"),
    )


def _claim(value: str) -> Column:
    """What no two surrogates may share: the canonical form among all numbers, or among its part and scope."""
    return F.concat_ws("\x1f", F.when(F.col("part").isin(*NUMBERS), "number").otherwise(F.col("part")), "scope", F.lower(value))


def _laid_out() -> Column:
    """The surrogate in the layout of ``entity``."""
    entity, fresh = F.col("entity"), F.col("fresh")
    signs = F.split(entity, "")
    upto = lambda i: F.char_length(F.regexp_replace(F.substring(entity, F.lit(1), i + 1), r"\D", ""))
    number = F.transform(signs, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(fresh, upto(i), F.lit(1))).otherwise(c))
    local = F.char_length(F.substring_index(entity, "@", 1))
    raised = lambda c, i: F.substring(entity, i + 1, F.lit(1)).rlike(r"\p{Lu}")
    mail = F.transform(F.split(fresh, ""), lambda c, i: F.when((i < local) & raised(c, i), F.upper(c)).otherwise(c))
    # Digits have no case: a secret without small letters stays without them.
    mixed = F.transform(F.split(fresh, ""), lambda c, i: F.when(raised(c, i), F.upper(c)).otherwise(c))
    return (
        F.when(F.col("kind").isin(*NUMBERS), F.array_join(number, ""))
        .when(F.col("kind") == "email", F.array_join(mail, ""))
        .when((F.col("kind") == "secret") & ~entity.rlike("[a-f]"), F.upper(fresh))
        .when(F.col("kind") == "secret", F.array_join(mixed, ""))
        .when(F.col("kind") == "name", F.concat(F.regexp_extract(entity, r"^(\S+ +)", 1), F.coalesce(F.concat("fresh_given", F.lit(" ")), F.lit("")), fresh))
        .otherwise(fresh)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """entity, kind and surrogate of every distinct entity (entity, kind); surrogates of entities
    that differ in canonical form are distinct, and none is itself an entity."""
    rows = _parts(entities)
    given = rows.where("given IS NOT NULL").select(F.lit("given").alias("part"), F.col("given").alias("canon"), "scope")
    parts = rows.select("part", "canon", F.lit("").alias("scope")).unionByName(given).distinct()
    # A full name is no entity if its family name is none.
    known = parts.where("part <> 'given'").select(_claim("canon").alias("claim"), F.lit(True).alias("real")).distinct()
    state = parts.withColumn("draw", F.lit(0))
    while True:
        drawn = state.withColumn("d", _draw(key)).select("part", "canon", "scope", "draw", _fresh().alias("fresh")).withColumn("claim", _claim("fresh"))
        first = Window.partitionBy("claim").orderBy("draw", "canon", "part")
        judged = materialize(
            drawn.withColumn("place", F.row_number().over(first))
            .join(known, "claim", "left")
            .select("part", "canon", "scope", "draw", "fresh", ((F.col("place") > 1) | F.col("real").isNotNull()).alias("again"))
        )
        if judged.where("again").isEmpty():
            break
        state = judged.select("part", "canon", "scope", (F.col("draw") + F.col("again").cast("int")).alias("draw"))
    givens = judged.where("part = 'given'").select(F.col("canon").alias("given"), F.col("fresh").alias("fresh_given"))
    whole = judged.where("part <> 'given'").select("part", "canon", "fresh")
    return rows.join(whole, ["part", "canon"]).join(givens, "given", "left").select("entity", "kind", _laid_out().alias("surrogate"))


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, and columns n_found and kinds (types found, sorted)."""
    plain = docs.drop("n_found", "kinds")
    names = plain.columns
    plain, own = set_aside(plain, ("_text", "_doc", "_key", "_new"))
    entities = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    row_key = F.xxhash64("text").alias("_text")
    # Exploding drops texts without entities, so the patterns run once over every text.
    found = plain.select("doc_id", row_key, F.posexplode(entities).alias("place", "entity"))
    places = materialize(found.withColumn("kind", _kind(F.col("entity"))))
    surrogates = assign(places.select("entity", "kind").distinct(), key)
    lists = (
        places.join(surrogates, ["entity", "kind"])
        .groupBy(F.col("doc_id").alias("_doc"), F.col("_text").alias("_key"))
        .agg(F.sort_array(F.collect_set(F.struct("place", "surrogate", "kind"))).alias("_new"))
    )
    fresh = F.concat(F.col("_new.surrogate"), F.array(F.lit("")))
    pieces = F.split("text", ANY, -1)
    replaced = F.array_join(F.flatten(F.zip_with(pieces, fresh, lambda a, b: F.array(a, b))), "")
    untouched = F.col("_new").isNull()
    return (
        plain.withColumn("_text", row_key)
        .join(lists, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_key")), "left")
        .select(
            *(F.when(untouched, F.col("text")).otherwise(replaced).alias(c) if c == "text" else column for c, column in zip(names, own, strict=True)),
            F.when(untouched, 0).otherwise(F.size("_new")).cast("long").alias("n_found"),
            F.when(untouched, "").otherwise(F.array_join(F.array_sort(F.array_distinct("_new.kind")), ",")).alias("kinds"),
        )
    )
