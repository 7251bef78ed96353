"""Personal data replaced by keyed, type-consistent surrogates.

Mentions are found by one pattern. Each is reduced to an entity (type and canonical form:
digits of a number, lower-cased address, each word of a name without its title), and every distinct entity
of the corpus gets one surrogate from a keyed hash: digits for digits, an address for an
address, a name of the same gender and script. Mentions of an entity in different notations
therefore get the same surrogate, each in its own notation.

Collision checks: a surrogate is taken only if no entity of the type looks like it and no
other entity has it; of several entities that draw the same, the first keeps it and the
others draw again. Rounds go on until all entities have their own, each written to the
shared folder. Nothing about entities is collected.

Only DataFrame functions are used. Texts that can hold a mention are matched to list them, and
those with mentions once more to put the parts together; only the former are shuffled.

Not detected: names without a title, telephone numbers without a plus, a separator or the
shapes of `PATTERNS` (ten digits in a row are no number to call), postal addresses, dates of birth.

Defined results: null texts stay null, texts without a mention stay as they are; a mention has
one replacement everywhere, whatever rows share an id or have none; further columns are kept; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.shared import row_identity, stored

# Titles with the gender they tell (m, f, or n for none), by script.
TITLES = {
    "latin": {
        "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr"],
        "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra"],
        "n": ["Dr", "Prof"],
    },
    "cyrillic": {"m": ["г-н", "господин"], "f": ["г-жа", "госпожа"], "n": ["д-р"]},
    "greek": {"m": ["κύριος", "κος"], "f": ["κυρία", "κα"], "n": ["δρ"]},
}
GIVEN = {
    "latin": {
        "m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Martin", "Oscar"],
        "f": ["Alma", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Ines", "Julia", "Laura", "Marta", "Nora"],
        "n": ["Alex", "Andrea", "Charlie", "Dominique", "Kim", "Luca", "Mika", "Noa", "Robin", "Sam", "Sascha", "Toni"],
    },
    "cyrillic": {
        "m": ["Андрей", "Борис", "Виктор", "Егор", "Иван", "Павел"],
        "f": ["Анна", "Вера", "Дарья", "Елена", "Мария", "Ольга"],
        "n": ["Женя", "Валя", "Саша", "Шура"],
    },
    "greek": {
        "m": ["Ανδρέας", "Γιάννης", "Νίκος", "Πέτρος"],
        "f": ["Άννα", "Ελένη", "Μαρία", "Σοφία"],
        "n": ["Αλέξ", "Χάρις"],
    },
}
SYLLABLES = {
    "latin": ["ba", "den", "fel", "gor", "han", "ker", "lan", "mar", "nel", "pol", "ran", "sel", "tor", "ver", "wal", "zim"],
    "cyrillic": ["ба", "вол", "гор", "дан", "зер", "кал", "лес", "мар", "нов", "пол", "рад", "сев", "тар", "фед", "хол", "чер"],
    "greek": ["βα", "γερ", "δαν", "ζερ", "καλ", "λαν", "μαρ", "νικ", "παλ", "ρεν", "σελ", "ταν", "φερ", "χαλ", "θεο", "ξεν"],
}

_ALL_TITLES = "|".join(sorted((t for s in TITLES.values() for g in s.values() for t in g), key=lambda t: (-len(t), t)))
NAME = r"(?<![\p{L}\p{N}])(?:" + _ALL_TITLES + r")\.? \p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+){0,2}"
#: In this order; the first that fits at a place counts.
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]{1,64}@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    # eight groups, or two runs of groups around ::, and a digit somewhere
    "ipv6": r"(?<![\p{L}\p{N}:.])(?=[0-9A-Fa-f:]*\d)"
    r"(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "card": r"(?<![\p{L}\d.+-])(?:\d{13,19}|\d{4}(?: \d{4}){2} \d{1,7}|\d{4}(?:-\d{4}){2}-\d{1,7}|\d{4} \d{6} \d{5})(?![\p{L}\d]|-\d)",
    "ssn": r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\p{L}\d]|-\d)",
    "phone": r"(?<![\p{L}\d])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?![\p{L}\d]|-\d)|(?<![\p{L}\d])\+\d(?:[ ./-]?\d){7,13}(?!\d)"
    # a trunk zero in brackets; national forms in pairs or with one break
    r"|(?<![\p{L}\d])\+\d{1,3}[ .-]?\(0\)[ .-]?\d(?:[ ./-]?\d){6,11}(?!\d)|(?<![\p{L}\d.,-])0[1-9](?:[ .]\d{2}){4}(?![\p{L}\d]|[.,-]\d)"
    r"|(?<![\p{L}\d.,-])0\d{2,4}[ /-]\d{6,8}(?![\p{L}\d]|[.,-]\d)",
    "name": NAME,
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
ROUNDS = 64
#: The key of the registered query; a real run passes a secret of its own.
KEY = "example key"
DIGITS = ("card", "ssn", "phone", "iban")


def possible(text: Column) -> Column:
    """Whether a text can hold a mention: all have a digit or an at sign, but for names.

    Far cheaper than the whole pattern, which then runs over these texts only.
    """
    return F.coalesce(text.rlike("[0-9@]") | text.rlike(NAME), F.lit(False))


def mentions(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), 0)


def kind(mention: Column) -> Column:
    found = F.when(mention.contains("@"), "email")
    for name in ("name", "ipv6", "ip", "ssn", "phone", "iban", "card"):
        # whole mentions only: what stands around them was judged where they were found
        found = found.when(mention.rlike(f"^(?:{PATTERNS[name]})$"), name)
    return found.otherwise("card")


def _title(mention: Column) -> Column:
    return F.regexp_extract(mention, r"^(?:" + _ALL_TITLES + r")\.? ", 0)


def parts(mention: Column, of: Column) -> Column:
    """The entities of a mention, as an array of (kind, canon): what mentions of the same have in common.

    A name has one for each of its words, so that a family name alone stays recognisable.
    """
    words = F.split(_untitled(mention), " ")

    def word(w: Column, i: Column) -> Column:
        plain = F.initcap(F.lower(w))
        given = F.concat(_script(plain), F.lit(":"), _gender(mention), F.lit(":"), plain)
        last = i == F.size(words) - 1
        return F.struct(
            F.when(last, "family").otherwise("given").alias("kind"),
            F.when(last, F.concat(_script(plain), F.lit(":"), plain)).otherwise(given).alias("canon"),
        )

    canon = (
        F.when(of == "email", F.lower(mention))
        .when(of == "iban", F.regexp_replace(mention, " ", ""))
        .when(of == "ip", mention)
        .when(of == "ipv6", F.lower(mention))
        .otherwise(F.regexp_replace(mention, r"\D", ""))
    )
    return F.when(of == "name", F.transform(words, word)).otherwise(F.array(F.struct(of.alias("kind"), canon.alias("canon"))))


def _untitled(mention: Column) -> Column:
    return mention.substr(F.length(_title(mention)) + 1, F.length(mention))


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")


def _gender(mention: Column) -> Column:
    title = F.regexp_replace(_title(mention), r"\.? $", "")
    men, women = ([t for s in TITLES.values() for t in s[g]] for g in "mf")
    return F.when(title.isin(men), "m").when(title.isin(women), "f").otherwise("n")


def _shape(text: Column, digest: Column) -> Column:
    """Letters and digits of the text replaced one by one, its other characters kept."""
    letters, digits = F.translate(digest, "0123456789abcdef", "bcdfghjklmnprstv"), F.translate(digest, "abcdef", "135790")

    def one(c: Column, i: Column) -> Column:
        at = F.pmod(i, F.lit(128)) + 1
        return (
            F.when(c.rlike(r"\d"), digits.substr(at, F.lit(1)))
            .when(c.rlike(r"\p{Lu}"), F.upper(letters.substr(at, F.lit(1))))
            .when(c.rlike(r"\p{L}"), letters.substr(at, F.lit(1)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _hexadecimal(text: Column, digest: Column) -> Column:
    """Every hexadecimal digit replaced by one of the digest, none by a zero."""
    hexed = F.translate(digest, "0", "7")
    one = lambda c, i: F.when(c == ":", c).otherwise(hexed.substr(F.pmod(i, F.lit(128)) + 1, F.lit(1)))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _digits(text: Column, digest: Column, keep: int) -> Column:
    """The first `keep` characters, then a hash digit for each digit (a letter for each letter)."""
    return F.concat(text.substr(1, keep), _shape(text.substr(F.lit(keep + 1), F.length(text)), digest))


def _luhn(number: Column) -> Column:
    """Whether a digit string passes the checksum of card numbers."""
    values = F.transform(
        F.split(F.reverse(number), ""),
        lambda c, i: c.cast("int") * (1 + i % 2) - F.when((i % 2 == 1) & (c.cast("int") > 4), 9).otherwise(0),
    )
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _like_card(text: Column, made: Column) -> Column:
    """`made` with its last digit set so that it passes the checksum just if `text` does."""
    body = made.substr(F.lit(1), F.length(made) - 1)
    tries = F.filter(F.array(*[F.lit(str(d)) for d in range(10)]), lambda d: _luhn(F.concat(body, d)))
    valid = F.concat(body, tries[0])
    invalid = F.concat(body, ((tries[0].cast("int") + 1 + F.pmod(F.crc32(made.cast("binary")), F.lit(8)).cast("int")) % 10).cast("string"))
    return F.when(_luhn(text), valid).otherwise(invalid)


def surrogate(of: Column, canon: Column, key: str, draw: int) -> Column:
    """The canonical form of an entity's surrogate in one draw."""
    digest = F.sha2(F.concat(F.lit(f"{key}\x00{draw}\x00"), of, F.lit("\x00"), canon), 512)

    def number(at: int, size: int = 7) -> Column:
        return F.conv(digest.substr(at, size), 16, 10).cast("long")

    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    local = F.concat(_shape(local, digest), F.when(F.length(local) < 6, digest.substr(100, 6)).otherwise(F.lit("")))
    # the host's surrogate does not depend on the person, so people of one host stay together
    host = F.concat(F.lit("mail-"), F.sha2(F.concat(F.lit(f"{key}\x00host\x00"), domain), 256).substr(1, 10), F.lit(".example"))
    ip = F.concat_ws(".", *[(number(1 + 7 * k) % (223 if k == 0 else 254) + 1).cast("string") for k in range(4)])
    script, gender = F.split(canon, ":")[0], F.split(canon, ":")[1]
    family = given = F.lit(None).cast("string")
    for s, by_gender in GIVEN.items():
        syllables = F.array(*map(F.lit, SYLLABLES[s]))
        made = F.initcap(F.concat(*[syllables[(number(29 + 7 * k) % 16).cast("int")] for k in range(3 + min(draw, 5))]))
        family = F.when(script == s, F.concat(F.lit(f"{s}:"), made)).otherwise(family)
        for g, names in by_gender.items():
            # a later draw joins more names
            chosen = [F.array(*map(F.lit, names))[(number(1 + 7 * k) % len(names)).cast("int")] for k in range(1 + min(draw, 9))]
            given = F.when((script == s) & (gender == g), F.concat(F.lit(f"{s}:{g}:"), F.concat_ws("-", *chosen))).otherwise(given)
    return (
        F.when(of == "email", F.concat(local, F.lit("@"), host))
        .when(of == "ip", ip)
        .when(of == "ipv6", _hexadecimal(canon, digest))
        .when(of == "family", family)
        .when(of == "given", given)
        .when(of == "iban", _digits(canon, digest, 2))
        .when(of == "card", _like_card(canon, _digits(canon, digest, 1)))
        .when((of == "phone") & canon.startswith("0"), F.concat(F.lit("0"), _shape(canon.substr(F.lit(2), F.length(canon)), digest)))
        # a country code is the digits before the last ten
        .when((of == "phone") & (F.length(canon) > 10), F.concat(canon.substr(F.lit(1), F.length(canon) - 10), F.translate(digest.substr(120, 1), "0123456789abcdef", "2345678923456789"), _shape(canon.substr(F.lit(-9), F.lit(9)), digest)))
        .otherwise(_shape(canon, digest))
    )


def written(mention: Column, of: Column, made: Column) -> Column:
    """Canonical surrogates (an array, one for each part) in the notation of a mention."""
    canon, words = made[0], F.split(_untitled(mention), " ")

    def cased(word: Column, name: Column) -> Column:
        name = F.substring_index(name, ":", -1)
        return F.when((F.length(word) > 1) & (word == F.upper(word)), F.upper(name)).otherwise(name)

    shown = F.array_join(F.zip_with(words, made, cased), " ")

    def filled() -> Column:
        start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))

        def step(state: Column, c: Column) -> Column:
            own = c.rlike(r"[\p{L}\p{N}]")
            return F.struct(
                F.concat(state["text"], F.when(own, canon.substr(state["at"], F.lit(1))).otherwise(c)).alias("text"),
                (state["at"] + own.cast("int")).alias("at"),
            )

        return F.aggregate(F.split(mention, ""), start, step, lambda s: s["text"])

    return (
        F.when(of == "name", F.concat(_title(mention), shown))
        .when(of.isin(*DIGITS), filled())
        .otherwise(canon)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate), all surrogates of a kind different and none an entity."""
    done, pending = None, entities
    for draw in range(ROUNDS):
        made = pending.select("kind", "canon", surrogate(F.col("kind"), F.col("canon"), key, draw).alias("surrogate"))
        first = made.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon"))
        first = first.join(entities.select("kind", F.col("canon").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            first = first.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        first = stored(first.select("kind", "canon", "surrogate"))
        done = first if done is None else done.union(first)
        pending = stored(pending.join(first, ["kind", "canon"], "left_anti"))
        if pending.isEmpty():
            return done
    raise ValueError("too few surrogates of a kind for its entities")


def replacements(docs: DataFrame, key: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(`owner`: the identity of rows of one id and text, table: mention -> replacement).

    A table holds the mentions of one text, however many rows share an id or have none.
    """
    can = possible(F.col(text))
    listed = F.when(can, mentions(F.col(text)))
    owner = F.when(can, row_identity(doc, text))
    # an outer explode: an inner one would make the optimiser match every text twice
    found = docs.select(owner.alias("owner"), F.explode_outer(listed).alias("mention"))
    said = stored(found.filter("mention IS NOT NULL").distinct())
    forms = said.select("mention").distinct().withColumn("of", kind(F.col("mention")))
    forms = forms.select("mention", "of", F.posexplode(parts(F.col("mention"), F.col("of"))).alias("n", "part"))
    forms = stored(forms.select("mention", "of", "n", "part.*"))
    table = assign(stored(forms.select("kind", "canon").distinct()), key)
    made = F.sort_array(F.collect_list(F.struct("n", "surrogate")))["surrogate"]
    forms = forms.join(table, ["kind", "canon"]).groupBy("mention", "of").agg(made.alias("made"))
    forms = stored(forms.select("mention", written(F.col("mention"), F.col("of"), F.col("made")).alias("replacement")))
    rows = said.join(forms, "mention").groupBy("owner")
    return rows.agg(F.map_from_entries(F.collect_list(F.struct("mention", "replacement"))).alias("table"))


def replace(docs: DataFrame, key: str, doc: str = "doc_id", text: str = "text", count: str | None = None) -> DataFrame:
    """`docs` with all mentions replaced; `count` names a column for their number."""
    tables = stored(replacements(docs, key, doc, text)).select(F.col("owner").alias("_owner"), F.col("table").alias("_table"))
    # only texts that can hold a mention meet the tables; the others are not shuffled
    joined = docs.filter(possible(F.col(text))).join(tables, row_identity(doc, text) == F.col("_owner"), "left")
    table = F.col("_table")
    found = F.when(table.isNotNull(), mentions(F.col(text)))
    between = F.split(F.col(text), ANY, -1)
    new = F.concat(
        F.array_join(F.zip_with(F.slice(between, 1, F.size(found)), found, lambda a, m: F.concat(a, table[m])), ""),
        F.element_at(between, -1),
    )
    columns = [F.when(table.isNull(), F.col(text)).otherwise(new).alias(text) if c == text else F.col(c) for c in docs.columns]
    if count:
        columns.append(F.coalesce(F.size(found), F.lit(0)).cast("long").alias(count))
    others = docs.filter(~possible(F.col(text)))
    if count:
        others = others.withColumn(count, F.lit(0).cast("long"))
    return joined.select(*columns).unionByName(others)
