"""Personal data replaced by keyed surrogates of the same type and form.

Entities are found by one pattern. An entity's canonical form (digits without
their punctuation, lower-cased addresses, the name without its title) decides
its surrogate through a keyed SHA-256, so the same entity gets the same
surrogate in every document; the surrogate is then written in the form of each
mention. Surrogates are checked over all entities: two entities never share
one, and none is an entity of the input. Losers of a check try again with the
next keyed draw.

Only rows with entities take part in the joins; all others pass unshuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclaims.llm.words import bind
from sparkclaims.operators.joins import skew_join
from sparkclaims.storage import materialize

MAX_DRAWS = 64

# Given names by gender and script, surnames by script.
GIVEN = {
    ("f", "latin"): "Anna Maria Laura Julia Sarah Emma Claire Sophie Elena Lucia Carmen Ingrid Nadine Alice Helen Marta",
    ("m", "latin"): "John David Peter Thomas Michael Paul Pierre Louis Hans Klaus Carlos Miguel Antonio Robert James Felix",
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Светлана Татьяна",
    ("m", "cyrillic"): "Иван Пётр Сергей Дмитрий Алексей Николай Андрей Михаил",
    ("f", "greek"): "Μαρία Ελένη Κατερίνα Σοφία",
    ("m", "greek"): "Γιώργος Νίκος Δημήτρης Κώστας",
}
SURNAMES = {
    "latin": "Smith Miller Brown Taylor Weber Fischer Wagner Becker Martin Bernard Dubois Moreau Garcia Lopez Romero Navarro",
    "cyrillic": "Шевченко Коваленко Бондаренко Ткаченко Мельник Кравчук Савченко Марченко",
    "greek": "Αλεξίου Γεωργίου Δημητρίου Ιωάννου",
}
TITLES = {"m": "Mr|Herr|Señor|Monsieur", "f": "Mrs|Ms|Miss|Frau|Señora|Madame", "": "Dr|Prof"}

_GIVEN_ANY = "|".join(name for names in GIVEN.values() for name in names.split())
_TITLE_ANY = "|".join(TITLES.values())
# Repetitions of groups are possessive: Java's matcher does not recurse in them, however long an entity is.
_SURNAME = r"\p{Lu}\p{Ll}++(?:-\p{Lu}\p{Ll}++(?!\p{L}))*+"
_LABELS = r"(?:[A-Za-z0-9-]++\.(?=[A-Za-z]{2}|[A-Za-z0-9-]++\.))++[A-Za-z]{2,}+"
_TITLE = rf"(?:{_TITLE_ANY})\.? "

# In the order in which they are tried at a place of the text. A card is longer than the phone it begins like.
PATTERNS = {
    "email": rf"(?<![\w.+%-])[\w.+%-]++@{_LABELS}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?:sk|pk|ghp|xox[bp])[-_][0-9A-Za-z]{16,}|AKIA[0-9A-Z]{16})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ip6": r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5}|[0-9A-Fa-f]{1,4}:(?::[0-9A-Fa-f]{1,4}){2,6})(?![0-9A-Za-z:])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9+])(?:(?:[0-9]{4}[ -]){3}[0-9]{1,4}(?:[ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9](?:[ ./-]?\(?[0-9]\)?){7,14}|(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}|0[0-9]{1,4}[/-][0-9]{4,9}|0[0-9]{2,4} [0-9]{5,9})(?![0-9])",
    "number": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "name": rf"(?<![\p{{L}}])(?:{_TITLE})?(?:{_GIVEN_ANY}) {_SURNAME}(?![\p{{L}}])",
    "titled": rf"(?<![\p{{L}}]){_TITLE}{_SURNAME}(?![\p{{L}}])",
}
_DIGITS_ONLY = ("phone", "card", "ssn", "number")
# Inside a word of small letters no entity begins, so nothing is tried there.
_BEGIN = r"(?:(?=[0-9+(.%_\-\p{Lu}])|(?<![0-9A-Za-z])(?=[a-z]))"
ANY = _BEGIN + "(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"


def _kind(mention: Column) -> Column:
    """The first type whose pattern is the whole mention."""
    return F.coalesce(*[F.when(mention.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()])


def _canonical(kind: Column, mention: Column) -> Column:
    digits = F.regexp_replace(mention, "[^0-9]", "")
    return (
        F.when(kind.isin(*_DIGITS_ONLY), digits)
        .when(kind == "email", F.lower(mention))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind.isin("name", "titled"), F.regexp_replace(mention, rf"^{_TITLE}", ""))
        .otherwise(mention)
    )


def _gender(mention: Column) -> Column:
    """m or f by the title, else by the given name; null when neither tells."""
    by_title = [F.when(mention.rlike(rf"^(?:{titles})\.? "), F.lit(g)) for g, titles in TITLES.items() if g]
    given = F.substring_index(F.regexp_replace(mention, rf"^{_TITLE}", ""), " ", 1)
    by_name = [F.when(given.isin(*listed.split()), F.lit(g)) for (g, _), listed in GIVEN.items()]
    return F.coalesce(*by_title, *by_name)


def _full_name(mention: Column, mentions: Column) -> Column:
    """For a title with a surname: the one full name among the mentions of the
    text that it can stand for, by surname and gender; null if none or several."""
    surname, gender = F.substring_index(mention, " ", -1), _gender(mention)
    fits = F.filter(
        mentions,
        lambda m: m.rlike(f"^(?:{PATTERNS['name']})$")
        & (F.substring_index(m, " ", -1) == surname)
        & F.coalesce(_gender(m) == gender, F.lit(True)),
    )
    names = F.array_distinct(F.transform(fits, lambda m: F.regexp_replace(m, rf"^{_TITLE}", "")))
    return F.when(mention.rlike(f"^(?:{PATTERNS['titled']})$") & (F.size(names) == 1), F.try_element_at(names, F.lit(1)))


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a text of digits, its last digit counted once."""
    doubled = lambda d, at: F.when(at % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, at: doubled(c.cast("int"), at))
    return F.aggregate(values, F.lit(0), lambda total, d: total + d)


def _card(canon: Column, draw: Column) -> Column:
    """Digits as many as the card's; valid by the Luhn check when the card is."""
    body = _digits(F.substring(canon, F.lit(1), F.length(canon) - 1), draw)
    check = F.pmod(-_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(_luhn_sum(canon) % 10 == 0, F.concat(body, check)).otherwise(_digits(canon, draw))


def _draw(key: str, *parts: Column) -> Column:
    """64 keyed hex digits."""
    return F.sha2(F.concat_ws("\u0001", F.lit(key), *[p.cast("string") for p in parts]), 256)


def _number(draw: Column, place: Column | int, below: int) -> Column:
    """A number under ``below`` from eight hex digits of a draw."""
    part = F.substring(F.sha2(F.concat(draw, F.lit(place).cast("string") if isinstance(place, int) else place.cast("string")), 256), 1, 8)
    return F.conv(part, 16, 10).cast("long") % below


def _reshaped(text: Column, draw: Column, hexadecimal: bool = False) -> Column:
    """``text`` with each letter and digit replaced by one of its kind, the rest kept."""

    def replaced(c: Column, at: Column) -> Column:
        letter = lambda base, n: F.chr((_number(draw, at, n) + base).cast("long"))
        small = letter(97, 6 if hexadecimal else 26)
        large = letter(65, 6 if hexadecimal else 26)
        digit = _number(draw, at, 10).cast("string")
        return F.when(c.rlike("[0-9]"), digit).when(c.rlike("[a-z]"), small).when(c.rlike("[A-Z]"), large).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), replaced), "")


def _digits(text: Column, draw: Column) -> Column:
    """``text`` with each digit replaced; the first is never 0."""
    chars = F.split(text, "")
    return F.array_join(
        F.transform(
            chars,
            lambda c, at: F.when(
                c.rlike("[0-9]"),
                F.when(at == 0, 1 + _number(draw, at, 9)).otherwise(_number(draw, at, 10)).cast("string"),
            ).otherwise(c),
        ),
        "",
    )


def _surrogate(key: str) -> Column:
    """The surrogate of a canonical form, from its kind and the number of its draw."""
    kind, canon, attempt = F.col("kind"), F.col("canon"), F.col("attempt")
    draw = _draw(key, kind, canon, attempt)
    # Mentions of one domain share its surrogate, whatever the local part.
    domain = F.substring_index(canon, "@", -1)
    labels = F.regexp_replace(domain, r"\.[^.]+$", "")
    email = F.concat(
        _reshaped(F.substring_index(canon, "@", 1), draw),
        F.lit("@"),
        _reshaped(labels, _draw(key, F.lit("domain"), domain)),
        F.lit("."),
        F.substring_index(domain, ".", -1),
    )
    ip = F.concat_ws(".", *[(1 + _number(draw, k, 254)).cast("string") for k in range(4)])
    given = F.substring_index(canon, " ", 1)
    names = F.coalesce(
        *[
            F.when(
                given.isin(*listed.split()),
                F.concat(_other(listed, _number(draw, 0, len(listed.split())), given), F.lit(" "), _surname(script, draw)),
            )
            for (_, script), listed in GIVEN.items()
        ]
    )
    scripts = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}
    titled = F.coalesce(*[F.when(canon.rlike(letter), _surname(s, draw)) for s, letter in scripts.items()], _surname("latin", draw))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "name", names)
        .when(kind.isin("secret", "ip6"), _reshaped(canon, draw, hexadecimal=True))
        .when(kind == "card", _card(canon, draw))
        .when(kind == "titled", titled)
        .when(kind == "iban", F.concat(F.substring(canon, 1, 2), _reshaped(F.expr("substring(canon, 3)"), draw)))
        .otherwise(_digits(canon, draw))
    )


def _pick(listed: str, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in listed.split()]), (at + 1).cast("int"))


def _other(listed: str, at: Column, own: Column) -> Column:
    """The name at a place of the list, or the next one if that is the own name."""
    drawn = _pick(listed, at)
    return F.when(drawn == own, _pick(listed, (at + 1) % len(listed.split()))).otherwise(drawn)


def _surname(script: str, draw: Column) -> Column:
    """A surname of the script, not the own; every sixth further draw joins one more."""
    listed, own = SURNAMES[script], F.substring_index("canon", " ", -1)
    parts = F.transform(
        F.sequence(F.lit(1), 1 + F.floor((F.col("attempt") + 5) / 6).cast("int")),
        lambda k: _other(listed, _number(draw, k, len(listed.split())), own),
    )
    return F.array_join(parts, "-")


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, surrogate for distinct ``entities`` (kind, canon).

    Within a kind no two entities share a surrogate and no surrogate is an
    entity. Raises when 64 draws leave some entity without one.
    """
    table = materialize(entities.select("kind", "canon", F.lit(0).alias("attempt")).withColumn("surrogate", _surrogate(key)), "surrogates")
    for _ in range(MAX_DRAWS):
        taken = table.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("is_entity"))
        first = table.groupBy("kind", "surrogate").agg(F.min("canon").alias("owner"))
        checked = table.join(first, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
        again = F.col("is_entity").isNotNull() | (F.col("owner") != F.col("canon"))
        checked = materialize(
            checked.select("kind", "canon", "attempt", "surrogate", again.alias("again")), "checked"
        )
        if not checked.filter("again").limit(1).count():
            return checked.select("kind", "canon", "surrogate")
        redrawn = checked.withColumn("attempt", F.col("attempt") + F.col("again").cast("int"))
        table = materialize(
            redrawn.withColumn("surrogate", F.when(F.col("again"), _surrogate(key)).otherwise(F.col("surrogate"))).drop("again"),
            "surrogates",
        )
    raise ValueError(f"{MAX_DRAWS} draws left entities without a surrogate of their own")


def _in_form(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate written as the mention is: its punctuation, spaces, title and case."""

    def laid(pattern: str) -> Column:
        filled = F.aggregate(
            F.split(mention, ""),
            F.struct(F.lit("").alias("out"), F.lit(1).alias("next")),
            lambda acc, c: F.when(
                c.rlike(pattern),
                F.struct(F.concat(acc["out"], F.substring(surrogate, acc["next"], F.lit(1))).alias("out"), (acc["next"] + 1).alias("next")),
            ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["next"].alias("next"))),
            lambda acc: acc["out"],
        )
        return filled

    title = F.regexp_extract(mention, rf"^(?:{_TITLE})?", 0)
    surname_only = mention.rlike(f"^(?:{PATTERNS['titled']})$") & ~mention.rlike(f"^(?:{PATTERNS['name']})$")
    return (
        F.when(kind.isin(*_DIGITS_ONLY), laid("[0-9]"))
        .when(kind == "iban", laid("[0-9A-Z]"))
        .when((kind == "name") & surname_only, F.concat(title, F.substring_index(surrogate, " ", -1)))
        .when(kind.isin("name", "titled"), F.concat(title, surrogate))
        .when((kind == "email") & (mention == F.upper(mention)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def pseudonymise(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text with surrogates, and n_mentions (replaced) for every row of ``docs``.

    ``key`` decides all draws: the same key gives the same surrogates to the
    same set of entities. A text without entities stays byte by byte; null
    stays null with no mentions. Null and repeated ids keep their rows; an
    empty table gives no rows. Other columns are not read. Names are those
    that begin with a given name of the lists, or a title and a surname; the
    surrogate has the name's gender and script and keeps the title. A title
    with a surname stands for the one full name of its text with that surname
    and gender, if there is one, and else for the surname itself.
    """
    pattern = F.lit(ANY)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row_no")
    ).withColumn("mentions", F.regexp_extract_all("text", pattern, F.lit(0)))
    some = F.size("mentions") > 0
    found = materialize(rows.filter(some), "mentions")
    clear = rows.filter(~F.coalesce(some, F.lit(False)))

    uses = found.select("row_no", "mentions", F.explode(F.array_distinct("mentions")).alias("mention")).select(
        "row_no", "mention", _full_name(F.col("mention"), F.col("mentions")).alias("link")
    )
    kind = _kind(F.col("mention"))
    counted = materialize(uses.groupBy("mention", "link").agg(F.count("*").alias("_rows")), "uses")
    spoken = materialize(
        counted.select("mention", "link", F.when(F.col("link").isNotNull(), "name").otherwise(kind).alias("kind")).withColumn(
            "canon", F.coalesce("link", _canonical(F.col("kind"), F.col("mention")))
        ),
        "spoken",
    )
    mapped = spoken.join(surrogates(spoken.select("kind", "canon").distinct(), key), ["kind", "canon"])
    written = materialize(
        mapped.select("mention", "link", _in_form(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("written")), "written"
    )
    # A mention may be in a third of the texts.
    named = skew_join(uses, written, ["mention", "link"], "inner", null_safe=True, frequencies=lambda: counted)
    per_row = named.groupBy("row_no").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", "written"))).alias("by_mention")
    )
    pieces = F.split("text", ANY, -1)
    swapped = F.transform("mentions", lambda m: F.col("by_mention")[m])
    text = F.array_join(
        F.zip_with(pieces, F.concat(swapped, F.array(F.lit(""))), lambda piece, after: F.concat(piece, after)), ""
    )
    replaced = found.join(per_row, "row_no").select(
        "doc_id", text.alias("text"), F.size("mentions").cast("long").alias("n_mentions")
    )
    return clear.select("doc_id", "text", F.lit(0).cast("long").alias("n_mentions")).unionByName(replaced)
