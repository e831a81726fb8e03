"""Personal data replaced by keyed surrogates of the same kind, gender, script and format.

Entities are found by one pattern. Each distinct entity gets a surrogate derived from a
secret key, so the same person or number is replaced alike in every document. A
registry of all distinct entities is checked for collisions: two entities with one
surrogate, or a surrogate that is itself a real entity, give way to the next draw until
none is left. A given name has one gender: that of all its titled mentions, else that of
the lists of given names, else none, and names that fit both are drawn. Where a text has
a titled name, its later mentions without a title are replaced alike. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard.functions.binding import let
from duelboard.llm.tables import column, cut, free_name

# Patterns of the entities, titles by gender, and names to draw from.
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа"]
MALE_TITLES = ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин"]
OTHER_TITLES = ["Dr", "Prof"]
LATIN_FEMALE = ["Ada", "Clara", "Elena", "Greta", "Hanna", "Irene", "Julia", "Laura", "Maria", "Nora", "Paula", "Sofia"]
LATIN_MALE = ["Adam", "Bruno", "David", "Erik", "Felix", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Simon", "Victor"]
LATIN_FAMILY = ["Abel", "Berger", "Castro", "Dumont", "Ferrer", "Garnier", "Hansen", "Keller", "Lambert", "Moreno", "Novak", "Weber"]
CYRILLIC_FEMALE = ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"]
CYRILLIC_MALE = ["Антон", "Борис", "Виктор", "Денис", "Иван", "Максим", "Олег", "Павел"]
CYRILLIC_FAMILY = ["Белов", "Волков", "Громов", "Козлов", "Лебедев", "Морозов", "Орлов", "Соколов"]
LATIN_NEUTRAL = ["Alex", "Charlie", "Dominique", "Jamie", "Jules", "Kim", "Noel", "Robin", "Sam", "Sasha", "Toni", "Yael"]
CYRILLIC_NEUTRAL = ["Валя", "Женя", "Паша", "Саша", "Слава", "Шура"]
#: Given names that tell a gender where no title does.
FEMALE_GIVEN = ["Alice", "Amanda", "Ana", "Andrea", "Angela", "Anna", "Anne", "Barbara", "Carmen", "Catherine", "Charlotte", "Claire", "Emily", "Emma", "Eva", "Helen", "Ingrid", "Isabel", "Jane", "Jennifer", "Jessica", "Karen", "Katharina", "Linda", "Lisa", "Lucia", "Margaret", "Marie", "Mary", "Nancy", "Olivia", "Patricia", "Sarah", "Susan", "Teresa", "Ursula", "Екатерина", "Наталья", "Светлана", "Татьяна", "Юлия"]
MALE_GIVEN = ["Alejandro", "Andrew", "Antonio", "Carlos", "Charles", "Christopher", "Daniel", "Diego", "Edward", "Fernando", "Francisco", "Frank", "Georg", "George", "Hans", "Henry", "James", "Jean", "John", "Jorge", "Jose", "Joseph", "José", "Juan", "Klaus", "Luis", "Manuel", "Mark", "Matthew", "Michael", "Miguel", "Paul", "Pedro", "Peter", "Philippe", "Pierre", "Richard", "Robert", "Stefan", "Thomas", "William", "Wolfgang", "Александр", "Алексей", "Андрей", "Владимир", "Дмитрий", "Михаил", "Сергей", "Николай"]
LATIN_SYLLABLES = ["ba", "de", "fi", "go", "hu", "ka", "le", "mi", "no", "pu", "ra", "se", "ti", "vo", "wa", "zu"]
CYRILLIC_SYLLABLES = ["ба", "де", "фи", "го", "ху", "ка", "ле", "ми", "но", "пу", "ра", "се", "ти", "во", "ва", "зу"]
_SECRET_WORD = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)"
#: What stays of a secret: the sign and quote before it, or the prefix of an access key.
SECRET_HEAD = r"[=:]\s{0,3}[\"']?|AKIA"
_NAME = r"\p{Lu}[\p{L}'’-]+"
#: A capitalised word outside of the entities, a mention of a name if the text has a titled one.
MENTION = r"(?<![\p{L}\d_])\p{Lu}[\p{L}'’-]*"
#: What a name ends with in the genitive; it stays.
GENITIVE = r"(?:['’]s|['’-]+)$"
_TITLE = "|".join(sorted(FEMALE_TITLES + MALE_TITLES + OTHER_TITLES, key=len, reverse=True))
# Each pattern but the first starts with one sign of a small class, which fails fast, and
# looks behind that sign afterwards.
PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]++@[\w-]+(?:\.[\w-]+)+",
    "secret": r"A(?<!\wA)KIA[0-9A-Z]{16}(?!\w)|[=:](?<=" + _SECRET_WORD + r"\s{0,3}[=:])\s{0,3}[\"']?[^\s\"']{6,}",
    "ip": r"\d(?<![\w.]\d)\d{0,2}(?:\.\d{1,3}){3}(?!\w|\.\d)",
    "ssn": r"\d(?<![\w-]\d)\d{2}-\d{2}-\d{4}(?![\w-])",
    "card": r"\d(?<![\w+-]\d)(?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"[+(\d](?<![\w+][+(\d])(?:(?<=\+)\d{1,3}[ .-]?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])|(?<=\()\d{2,4}\) ?|(?<=\d)\d{1,3}[ .-])\d{3,4}[ .-]?\d{3,4}(?!\w)",
    "person": r"[" + "".join(sorted({t[0] for t in FEMALE_TITLES + MALE_TITLES + OTHER_TITLES})) + r"](?<!\p{L}.)(?<=(?=(?:" + _TITLE + r")(?!\p{L})).)\p{L}*\.? " + _NAME + "(?: " + _NAME + ")?",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these holds no entity; one pass over a text tells.
HINT = r"[0-9@=:]|AKIA|" + PATTERNS["person"]


def holds_entity(text: Column) -> Column:
    return F.coalesce(F.when(text.rlike(HINT), text.rlike(ENTITY)), F.lit(False))


def entity_kind(raw: Column) -> Column:
    """Kind of an entity that the pattern found."""
    kind = F.lit("person")
    for name, pattern in reversed([p for p in PATTERNS.items() if p[0] not in ("person", "secret")]):
        kind = F.when(raw.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return F.when(raw.rlike("^(?:" + SECRET_HEAD + ")"), "secret").otherwise(kind)


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, r"\D", "")


def _name_canon(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, GENITIVE, ""))


def entity_parts(raw: Column) -> Column:
    """Array of (kind, canon, gender): what must be replaced alike wherever it occurs.

    Case, genitive and format do not tell entities apart, nor does a country code: a phone
    number is its last ten digits. A person has a given and a family name, or only the
    latter, so "Mr. Smith" shares the family name of "Mr. John Smith". The gender is that
    of the title.
    """
    kind = entity_kind(raw)
    title = F.regexp_extract(raw, r"^([^ .]+)", 1)
    names = F.split(F.regexp_replace(raw, r"^[^ .]+\.? ", ""), " ")
    gender = F.when(title.isin(FEMALE_TITLES), "f").when(title.isin(MALE_TITLES), "m").otherwise("n")
    script = lambda name: F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    part = lambda k, canon, g: F.struct(k.alias("kind"), canon.alias("canon"), g.alias("gender"))
    family = F.element_at(names, -1)
    none = F.lit("")
    person = F.when(
        F.size(names) > 1,
        F.array(
            part(F.concat(F.lit("given-"), script(names[0])), _name_canon(names[0]), gender),
            part(F.concat(F.lit("family-"), script(family)), _name_canon(family), none),
        ),
    ).otherwise(F.array(part(F.concat(F.lit("family-"), script(family)), _name_canon(family), none)))
    value = F.regexp_replace(raw, "^(?:" + SECRET_HEAD + ")", "")
    canon = F.when(kind == "email", F.lower(raw)).when(kind == "secret", value).when(kind == "ip", raw)
    canon = canon.when(kind == "phone", F.right(_digits(raw), F.lit(10))).otherwise(_digits(raw))
    return F.when(kind == "person", person).otherwise(F.array(part(kind, canon, none)))


def _draw(stream: Column, i: Column | int) -> Column:
    """Number 0 to 255 at place ``i`` of a hex stream of 64 bytes, differing from round to round beyond."""
    i = i if isinstance(i, Column) else F.lit(i)
    byte = F.conv(F.substring(stream, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
    return (byte + F.floor(i / 64).cast("int") * 89) % 256


def _shaped(text: Column, stream: Column, offset: int = 0) -> Column:
    """Each ASCII digit, lower-case and upper-case letter replaced by one of its class; hex texts stay hex."""
    hex_only = text.rlike("^[0-9a-f]*$")
    alphabet = lambda chars, n: F.substring(F.lit(chars), n % len(chars) + 1, F.lit(1))

    def sign(c: Column, i: Column) -> Column:
        n = _draw(stream, i + offset)
        return (
            F.when(hex_only, alphabet("0123456789abcdef", n))
            .when(c.rlike("[0-9]"), alphabet("0123456789", n))
            .when(c.rlike("[a-z]"), alphabet("abcdefghijklmnopqrstuvwxyz", n))
            .when(c.rlike("[A-Z]"), alphabet("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), sign), "")


def _random_digits(stream: Column, n: Column, offset: int = 0) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: (_draw(stream, i + offset) % 10).cast("string")), "")


def _luhn(body: Column) -> Column:
    """Check digit that makes ``body`` and it a valid card number."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    terms = F.transform(F.split(F.reverse(body), ""), lambda c, i: F.when(i % 2 == 0, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return ((10 - F.aggregate(terms, F.lit(0), lambda a, d: a + d) % 10) % 10).cast("string")


def _drawn_name(names: list[str], syllables: list[str], ending: str, stream: Column, attempt: Column) -> Column:
    """A name of the list for the first draws, later one made of syllables."""
    pick = lambda items, i: F.element_at(F.array(*[F.lit(x) for x in items]), (_draw(stream, i) % len(items) + 1).cast("int"))
    made = F.concat(*[pick(syllables, i) for i in range(1, 5)], F.lit(ending))
    return F.lower(F.when(attempt < 2, pick(names, 0)).otherwise(made))


def surrogate(kind: Column, canon: Column, gender: Column, attempt: Column, key: str) -> Column:
    """Canonical surrogate of an entity part at one attempt."""
    stream = F.sha2(F.concat_ws("|", F.lit(key), kind, gender, attempt.cast("string"), canon), 512)
    n = F.length(canon)
    from_two = lambda i: (_draw(stream, i) % 8 + 2).cast("string")
    ten = F.substring(F.concat(from_two(0), _random_digits(stream, F.lit(2), 1), from_two(3), _random_digits(stream, F.lit(6), 4)), F.lit(1), F.least(n, F.lit(10)))
    body = F.concat(F.substring(canon, 1, 1), _random_digits(stream, n - 2, 1))
    ip = F.concat_ws(".", *[(_draw(stream, i) % 254 + 1).cast("string") for i in range(4)])
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    labels = F.split(domain, r"\.")
    more = F.when(attempt < 3, "").otherwise(F.concat(F.lit("."), F.substring(stream, 100, 8)))
    below = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0)))
    sub = F.when(F.size(below) > 0, F.concat(_shaped(F.array_join(below, "."), stream, 32), F.lit("."))).otherwise("")
    email = F.concat(_shaped(local, stream), more, F.lit("@"), sub, F.lit("example."), F.element_at(labels, -1))
    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", ten).when(kind == "card", F.concat(body, _luhn(body)))
    out = out.when(kind == "ssn", F.concat((_draw(stream, 0) % 8 + 1).cast("string"), _random_digits(stream, F.lit(8), 1)))
    out = out.when(kind == "secret", _shaped(canon, stream))
    for script, female, male, neutral, family, syllables, ends in (
        ("latin", LATIN_FEMALE, LATIN_MALE, LATIN_NEUTRAL, LATIN_FAMILY, LATIN_SYLLABLES, ("a", "n", "i")),
        ("cyrillic", CYRILLIC_FEMALE, CYRILLIC_MALE, CYRILLIC_NEUTRAL, CYRILLIC_FAMILY, CYRILLIC_SYLLABLES, ("а", "н", "и")),
    ):
        of = lambda names, ending: _drawn_name(names, syllables, ending, stream, attempt)  # noqa: B023, E731
        given = F.when(gender == "f", of(female, ends[0])).when(gender == "m", of(male, ends[1])).otherwise(of(neutral, ends[2]))
        out = out.when(kind == f"given-{script}", given).when(kind == f"family-{script}", _drawn_name(family, syllables, ends[1], stream, attempt))
    return out


def _in_format(raw: Column, kind: Column, piece: Column) -> Column:
    """A canonical surrogate in the format of the raw entity (of one part)."""
    own = _digits(raw)  # digits before the part that has a surrogate, a country code, stay
    digits = F.concat(F.substring(own, F.lit(1), F.greatest(F.length(own) - F.length(piece), F.lit(0))), piece)
    digit = lambda c, i: F.when(c.rlike("[0-9]"), F.substring(digits, F.length(_digits(F.substring(raw, F.lit(1), i + 1))), F.lit(1))).otherwise(c)
    numbers = F.array_join(F.transform(F.split(raw, ""), digit), "")
    head = F.regexp_extract(raw, "^(?:" + SECRET_HEAD + ")", 0)
    return F.when(kind.isin("phone", "card", "ssn"), numbers).when(kind == "secret", F.concat(head, piece)).when((kind == "email") & (raw == F.upper(raw)), F.upper(piece)).otherwise(piece)


def _in_case(name: Column, piece: Column) -> Column:
    return F.when((F.length(name) > 1) & (name == F.upper(name)), F.upper(piece)).otherwise(F.initcap(piece))


def resolved_genders(parts: DataFrame) -> DataFrame:
    """(kind, canon, gender), one row per kind and canon, of parts with the genders of their titles.

    Titles of both genders make a name neutral, as does a name without a telling title
    that is in no list or in both.
    """
    lower = lambda names: [n.lower() for n in names]
    female, male = (
        F.col("kind").startswith("given-") & F.col("canon").isin(lower(names)) for names in (LATIN_FEMALE + CYRILLIC_FEMALE + FEMALE_GIVEN, LATIN_MALE + CYRILLIC_MALE + MALE_GIVEN)
    )
    titled = parts.groupBy("kind", "canon").agg(F.max(F.col("gender") == "f").alias("f"), F.max(F.col("gender") == "m").alias("m"))
    known = F.when(F.col("f") & F.col("m"), "n").when(F.col("f"), "f").when(F.col("m"), "m")
    listed = F.when(female & ~male, "f").when(male & ~female, "m").when(F.col("kind").startswith("given-"), "n").otherwise("")
    return titled.select("kind", "canon", F.coalesce(known, listed).alias("gender"))


def registry(parts: DataFrame, key: str) -> DataFrame:
    """(kind, canon, gender, surrogate) of all distinct parts (kind, canon, gender), free of collisions.

    Rounds end when no two parts of a kind share a surrogate and none is a real part.
    A part that keeps its surrogate keeps it for good; of parts that draw the same one in
    the same round, the first in order keeps it.
    """
    own = surrogate(F.col("kind"), F.col("canon"), F.col("gender"), F.col("attempt"), key)
    drawn = cut(parts.distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", own), "registry")
    real = drawn.select("kind", F.col("canon").alias("surrogate")).distinct()
    while True:
        shared = drawn.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "canon", "gender")).alias("keeper")).where("n > 1")
        losers = drawn.join(shared, ["kind", "surrogate"]).where(F.struct("attempt", "canon", "gender") != F.col("keeper")).select("kind", "canon", "gender")
        taken = drawn.join(real, ["kind", "surrogate"], "left_semi").select("kind", "canon", "gender")
        again = cut(losers.unionByName(taken).distinct().withColumn("again", F.lit(1)), "again")
        if again.isEmpty():
            return drawn.drop("attempt")
        drawn = cut(
            drawn.join(again, ["kind", "canon", "gender"], "left")
            .withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0)))
            .withColumn("surrogate", F.when(F.col("again") == 1, own).otherwise(F.col("surrogate")))
            .drop("again"),
            "registry",
        )


def _renamed(gap: Column, names: Column) -> Column:
    """(text, number of mentions) of the text between two entities, its mentions of known names replaced."""
    words, rest = F.regexp_extract_all(gap, F.lit(MENTION), 0), F.split(gap, MENTION, -1)

    def rename(word: Column) -> Column:
        new = F.element_at(names, _name_canon(word))
        return F.struct(F.coalesce(F.concat(_in_case(word, new), F.regexp_extract(word, GENITIVE, 0)), word).alias("word"), new.isNotNull().alias("known"))

    def fuse(own: Column) -> Column:
        text = F.array_join(F.zip_with(rest, own, lambda gap, new: F.concat(gap, F.coalesce(new["word"], F.lit("")))), "")
        return F.struct(text.alias("text"), F.size(F.filter(own, lambda new: new["known"])).alias("n"))

    return let(F.transform(words, rename), fuse)


def replace_entities(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with every entity of ``text`` replaced; all other columns and texts are unchanged.

    Equal entities get equal surrogates in all rows, different ones different ones; a
    capitalised word that is part of a titled name in the same text is replaced like it,
    with or without a title. Null and empty texts hold no entity; long ones are read
    whole. ``count`` names an added column with the number of entities and mentions
    replaced. Repeated rows, and rows of a repeated id, are each replaced by their own text.
    """
    content, columns = column(docs, text), docs.columns
    has = holds_entity(content)
    marked = docs.where(has)
    found = F.regexp_extract_all(content, F.lit(ENTITY), 0)
    raws = cut(marked.select(F.xxhash64(content).alias("h"), F.explode(F.array_distinct(found)).alias("raw")).distinct(), "raws")
    entities = cut(raws.select("raw").distinct().withColumn("kind_of", entity_kind(F.col("raw"))).withColumn("parts", entity_parts(F.col("raw"))), "entities")
    parts = entities.select("raw", "kind_of", F.posexplode("parts").alias("place", "part")).select("raw", "kind_of", "place", "part.*")
    names = registry(resolved_genders(parts), key).drop("gender")
    pieces = parts.join(names, ["kind", "canon"]).groupBy("raw", "kind_of").agg(F.sort_array(F.collect_list(F.struct("place", "surrogate", "kind", "canon"))).alias("pieces"))
    raw, first = F.col("raw"), F.col("pieces")[0]["surrogate"]
    title = F.regexp_extract(raw, r"^[^ .]+\.? ", 0)
    words = F.split(F.regexp_replace(raw, r"^[^ .]+\.? ", ""), " ")
    renamed = F.transform("pieces", lambda p, i: F.concat(_in_case(F.get(words, i), p["surrogate"]), F.regexp_extract(F.get(words, i), GENITIVE, 0)))
    person = F.concat(title, F.concat_ws(" ", renamed))
    is_person = F.col("kind_of") == "person"
    new = F.when(is_person, person).otherwise(_in_format(raw, F.col("kind_of"), first)).alias("new")
    replaced = cut(pieces.select("raw", new, F.when(is_person, F.col("pieces")).alias("pieces")), "replaced")
    own = cut(raws.join(replaced, "raw"), "replacements")
    maps = own.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("raw", "new"))).alias("map"))
    people = own.where("pieces is not null").select("h", F.explode("pieces").alias("piece")).groupBy("h", F.col("piece.canon").alias("canon"))
    # a word that is both a given and a family name in a text counts as the latter
    people = people.agg(F.min(F.struct("piece.kind", "piece.surrogate"))["surrogate"].alias("name"))
    people = people.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("canon", "name"))).alias("names"))
    h, by, known, done = (free_name(docs, name) for name in ("entity_h", "entity_map", "entity_names", "entity_done"))
    maps = maps.join(people, "h", "left").select(F.col("h").alias(h), F.col("map").alias(by), F.col("names").alias(known))
    joined = marked.withColumn(h, F.xxhash64(content)).join(maps, h)
    body = F.col("`" + text.replace("`", "``") + "`")
    ents, gaps = F.regexp_extract_all(body, F.lit(ENTITY), 0), F.split(body, ENTITY, -1)
    gaps = F.transform(gaps, lambda gap: F.when(F.col(known).isNotNull(), _renamed(gap, F.col(known))).otherwise(F.struct(gap.alias("text"), F.lit(0).alias("n"))))
    swap = lambda ent: F.when(ent.isNull(), "").otherwise(F.coalesce(F.element_at(F.col(by), ent), ent))

    def fuse(gaps: Column) -> Column:
        whole = F.array_join(F.zip_with(gaps, ents, lambda gap, ent: F.concat(gap["text"], swap(ent))), "")
        return F.struct(whole.alias("text"), (F.size(ents) + F.aggregate(gaps, F.lit(0), lambda n, gap: n + gap["n"])).alias("n"))

    keep = lambda df, value, n: df.select(
        *[value.alias(c) if c == text else F.col("`" + c.replace("`", "``") + "`") for c in columns], *([n.cast("int").alias(count)] if count else [])
    )
    fused = joined.withColumn(done, let(gaps, fuse))
    return keep(fused, F.col(done)["text"], F.col(done)["n"]).unionByName(keep(docs.where(~has), body, F.lit(0)))
