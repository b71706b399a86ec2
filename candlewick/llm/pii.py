"""Replacement of personal data by surrogates, in DataFrame functions only.

Detected entities are cut into parts (a mailbox and its domain, the words of a name), as far as these are
shared between entities. Every distinct part gets a surrogate from a keyed hash, of its own type, gender,
script and format. Surrogates that fall on one another or on a part that occurs are drawn anew, so different
entities stay different, and as one part has one surrogate everywhere, equal ones stay equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import split_by
from candlewick.sources.storage import stored

ROUNDS = 60  # draws until every part has a surrogate of its own; each second one lengthens words

# Forms of address, by the gender that they tell.
MALE = ("Mr", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "Signor", "господин", "г-н", "κύριος")
FEMALE = ("Mrs", "Ms", "Frau", "Señora", "Señorita", "Sra", "Madame", "Mme", "Signora", "госпожа", "г-жа", "κυρία")
NEITHER = ("Dr", "Prof", "Professor")

# Syllables of made-up names and endings by gender (male, female, neither), by script.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ja jo ka ke la le lo ma me mi na ne no pa ra re ri sa so ta te va vi za",
    "cyrillic": "ба бе во га го да де же за ка ки ла ле ло ма ме ми на не но па ра ре ри са со та те фа ха ша",
    "greek": "βα βε γα γε δα δη θα θε κα κε λα λε λο μα με μι να νε νο πα ρα ρε ρι σα σο τα τε φα χα ψα",
}
ENDINGS = {
    "latin": ("ldo rto nis mon", "lia na rina tta", "ren lin ley vyn"),
    "cyrillic": ("слав мир ван дор", "лия на рина тта", "рен лин ви ко"),
    "greek": ("ιος ρος νης των", "λια να ρινα θη", "ρεν λιν βι κο"),
}
SURNAME_ENDINGS = {"latin": "man son dal ner", "cyrillic": "енко чук ич дзе", "greek": "ακης ίδης άκος έας"}

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
ADDRESS = rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?![\w]|\.[0-9])"
PERSONAL = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
# Card numbers in one piece or in the usual groups. To groups of four, those of an expiry date, a check number or a
# leading number may belong or not, which the check digit tells.
FOURS = "|".join(
    rf"[0-9]{{4}}(?:{s}[0-9]{{4}}){{3}}(?:{s}[0-9]{{4}}(?!{s}?[0-9]{{4}}))?(?:{s}[0-9]{{3}})?" for s in " -"
)
_GROUPS = "|".join(rf"[0-9]{{4}}{s}[0-9]{{6}}{s}[0-9]{{4,5}}" for s in " -")
_AFTER = r"(?!\w|\.[0-9]|-(?![0-9]{1,4}(?![\w-])))"
_USUAL = rf"(?:[0-9]{{13,19}}|{FOURS}|{_GROUPS}){_AFTER}"
#: Other groups only where no usual ones begin within.
_OTHER = rf"(?!(?:[0-9][ -]?){{1,12}}(?<=[ -]){_USUAL})[0-9](?:[ -]?[0-9]){{12,18}}(?![\w-]|\.[0-9])"
CARD = rf"(?<![\w.-])(?:{_USUAL}|{_OTHER})"
_NORTH = r"(?<![\w+.-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])"
_STEP = rf"(?:(?:[ ./-]|[ ./-]?\(|\)[ ./-]?)(?!{_USUAL}))?[0-9]"
#: Ten digits in groups of 3, 3 and 4, or a country code and 7 to 15 digits with it, in one piece or in any groups.
PHONE = rf"{_NORTH}|(?<![\w+.-])\+[1-9](?:[0-9]{{6,14}}|(?:{_STEP}){{6,14}})(?![\w-])"
SECRET = (
    r"(?<![\w])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,})(?![\w])"
)
NAME = (
    rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(sorted(MALE + FEMALE + NEITHER, key=len, reverse=True))})\.?"
    r"(?: \p{Lu}[\p{L}'’-]+){1,3}"
)
PATTERN = "|".join((EMAIL, PERSONAL, PHONE, ADDRESS, CARD, SECRET, NAME))
#: Holds for every text with an entity, and is fast.
HINT = rf"[@0-9]|[0-9A-Fa-f]{{32}}|AKIA|sk-|ghp_|{'|'.join(MALE + FEMALE + NEITHER)}"


def _whole(text: Column, pattern: str) -> Column:
    return text.rlike(f"^(?:{pattern})$")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits by 10; 0 for a valid number."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10


# The first digits of card issuers, each with the digits that may follow.
ISSUERS = (
    "4[0-9]{12}(?:[0-9]{3}){0,2}",
    "5[1-5][0-9]{14}",
    "2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12}",
    "3[47][0-9]{13}",
    "3(?:0[0-5]|[689][0-9])[0-9]{11,16}",
    "35(?:2[89]|[3-8][0-9])[0-9]{12,15}",
    "6(?:011|4[4-9][0-9]|5[0-9]{2})[0-9]{12,15}",
    "62[0-9]{14,17}",
    "(?:5018|5020|5038|5893|6304|6759|676[1-3])[0-9]{9,15}",
)
ISSUED = f"^(?:{'|'.join(ISSUERS)})$"


def _card(entity: Column) -> Column:
    """(at, size) of the card number among the digits of an entity.

    Null without digits that an issuer gives out, in its length and with a right check digit.
    """
    digits = _digits(entity)
    n, fours = F.length(digits), _whole(entity, FOURS)
    spans = [(0, n, n <= 19), (0, F.lit(16), fours & (n > 16)), (4, F.lit(16), fours & (n >= 20)),
             (4, F.lit(19), fours & (n == 23))]

    def valid(at: int, size: Column, fits: Column) -> Column:
        number = F.substr(digits, F.lit(at + 1), size)
        return fits & number.rlike(ISSUED) & (_luhn(number) == 0)

    return F.coalesce(
        *[F.when(valid(at, size, fits), F.struct(F.lit(at).alias("at"), size.alias("size"))) for at, size, fits in spans]
    )


def _kind(entity: Column) -> Column:
    """Type of a detected entity; null for numbers that only look like a card."""
    return (
        F.when(entity.contains("@"), "email")
        .when(_whole(entity, PERSONAL), "personal")
        .when(_whole(entity, PHONE), "phone")
        .when(_whole(entity, ADDRESS), "address")
        .when(_whole(entity, CARD) & _card(entity).isNotNull(), "card")
        .when(_whole(entity, CARD), F.lit(None))
        .when(_whole(entity, SECRET), "secret")
        .otherwise("name")
    )


def _part(kind: Column | str, value: Column, gender: Column | int = 0) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    gender = F.lit(gender) if isinstance(gender, int) else gender
    return F.struct(kind.alias("part"), value.alias("value"), gender.cast("int").alias("gender"))


def _parts(kind: Column, entity: Column) -> Column:
    """Parts of an entity that have a surrogate of their own, in order; gender is 1, -1 or 0."""
    low = F.lower(entity)
    title = F.regexp_extract(entity, r"^([^ .]+)", 1)
    gender = F.when(title.isin(*MALE), 1).when(title.isin(*FEMALE), -1).otherwise(0)
    words = F.filter(F.split(low, " "), lambda w, i: i > 0)
    named = F.transform(
        words,
        lambda w, i: _part(
            F.when(i == F.size(words) - 1, "surname").otherwise("given"),
            w,
            F.when(i == F.size(words) - 1, 0).otherwise(gender),
        ),
    )
    plus = F.when(entity.startswith("+"), "+").otherwise("")
    card = _card(entity)
    number = (
        F.when(kind == "phone", F.concat(plus, _digits(entity)))
        .when(kind == "card", F.substr(_digits(entity), card["at"] + 1, card["size"]))
        .when(kind == "personal", _digits(entity))
    )
    return (
        F.when(
            kind == "email",
            F.array(_part("mailbox", low), _part("domain", F.regexp_extract(low, "@(.*)$", 1))),
        )
        .when(kind == "name", named)
        .otherwise(F.array(_part(kind, F.coalesce(number, F.when(kind == "secret", low), entity))))
    )


def _stream(key: str) -> Column:
    """128 hexadecimal digits of a keyed hash of the part and the draw."""
    return F.sha2(F.concat_ws("|", F.lit(key), "part", "value", F.col("draw").cast("string")), 512)


def _number(stream: Column, i: Column) -> Column:
    """Number i (from 1) of the stream, below 65,536."""
    return F.conv(F.substr(stream, (i * 4 - 4) % 124 + 1, F.lit(4)), 16, 10).cast("int")


def _letter(alphabet: str, n: Column) -> Column:
    return F.substr(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))


def _like(text: Column, stream: Column) -> Column:
    """A text of the same form: digits for digits, letters for letters of their script."""

    def one(c: Column, i: Column) -> Column:
        n = _number(stream, i + 1)
        return (
            F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when(c.rlike(r"\p{IsCyrillic}"), _letter("абвгдежзиклмнопрстуфхцчшэюя", n))
            .when(c.rlike(r"\p{IsGreek}"), _letter("αβγδεζηθικλμνξοπρστυφχψω", n))
            .when(c.rlike(r"\p{L}"), _letter("abcdefghijklmnopqrstuvwxyz", n))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _pick(words: str, n: Column) -> Column:
    every = words.split(" ")
    return F.element_at(F.array(*[F.lit(w) for w in every]), (n % len(every) + 1).cast("int"))


def _named(stream: Column, length: Column, script: str, ending: Column) -> Column:
    first = F.transform(
        F.sequence(F.lit(1), length), lambda i: _pick(SYLLABLES[script], _number(stream, i + 1))
    )
    return F.concat(F.array_join(first, ""), ending)


def _surrogate() -> Column:
    """Surrogate of the row (part, value, gender, draw, stream); a card's check digit is still to be set."""
    part, value, draw, stream = F.col("part"), F.col("value"), F.col("draw"), F.col("stream")
    longer = F.repeat(F.lit("a"), F.floor(draw / 2).cast("int"))
    local = F.regexp_extract(value, "^(.*)@", 1)
    host, top = F.regexp_extract(value, r"^(.*)(\.[^.]+)$", 1), F.regexp_extract(value, r"(\.[^.]+)$", 1)
    digits = _like(_digits(value), stream)
    # Country code and card issuer show in the first digit, which stays.
    digits = F.concat(F.substring(_digits(value), 1, 1), F.substr(digits, F.lit(2)))
    octets = [(_number(stream, F.lit(i)) % 254 + 1).cast("string") for i in range(1, 5)]
    names = {}
    for script in SYLLABLES:
        ends = [_pick(e, _number(stream, F.lit(1))) for e in (*ENDINGS[script], SURNAME_ENDINGS[script])]
        ending = (
            F.when(part == "surname", ends[3])
            .when(F.col("gender") > 0, ends[0])
            .when(F.col("gender") < 0, ends[1])
            .otherwise(ends[2])
        )
        names[script] = _named(stream, F.lit(2) + F.floor(draw / 2).cast("int"), script, ending)
    name = (
        F.when(value.rlike(r"\p{IsCyrillic}"), names["cyrillic"])
        .when(value.rlike(r"\p{IsGreek}"), names["greek"])
        .otherwise(names["latin"])
    )
    turns = F.ceil(F.length(value) / 128).cast("int")
    hexadecimal = F.substr(F.repeat(stream, turns), F.lit(1), F.length(value))
    prefix = F.regexp_extract(value, "^(akia|ghp_|sk-)", 1)
    secret = F.when(prefix == "", hexadecimal).otherwise(
        F.concat(prefix, _like(F.substr(value, F.length(prefix) + 1), stream))
    )
    return (
        F.when(part == "mailbox", _like(F.concat(local, longer), stream))
        .when(part == "domain", F.concat(_like(F.concat(host, longer), stream), top))
        .when(part.isin("given", "surname"), name)
        .when(part == "phone", F.concat(F.when(value.startswith("+"), "+").otherwise(""), digits))
        .when(part.isin("card", "personal"), digits)
        .when(part == "address", F.concat_ws(".", *octets))
        .otherwise(secret)
    )


def _drawn(rows: DataFrame, key: str) -> DataFrame:
    """`rows` (part, value, gender, draw) with a column surrogate."""
    rows = rows.withColumn("stream", _stream(key)).withColumn("made", _surrogate())
    short = F.expr("left(made, length(made) - 1)")
    check = (F.lit(10) - _luhn(F.concat(short, F.lit("0")))) % 10
    whole = F.when(F.col("part") == "card", F.concat(short, check.cast("string"))).otherwise(F.col("made"))
    return rows.withColumn("surrogate", whole).drop("stream", "made")


def surrogates(parts: DataFrame, key: str) -> DataFrame:
    """(part, value, surrogate) for distinct `parts` (part, value, gender).

    No two values of a part share a surrogate and none is a value that occurs. Every round draws for the
    values still without one; those that meet an earlier surrogate, an occurring value or another draw (of
    which the first value wins) go on to the next. A type without room for all its values raises.
    """
    taken, left = None, parts.withColumn("draw", F.lit(0))
    real = parts.select("part", F.col("value").alias("surrogate"))
    real = real.unionByName(
        parts.filter("part = 'mailbox'").select("part", F.regexp_extract("value", "^(.*)@", 1).alias("surrogate"))
    )
    for draw in range(ROUNDS):
        drawn = _drawn(left.withColumn("draw", F.lit(draw)), key)
        first = F.row_number().over(Window.partitionBy("part", "surrogate").orderBy("value"))
        drawn = drawn.withColumn("free", first == 1)
        used = real if taken is None else real.unionByName(taken.select("part", "surrogate"))
        used = used.distinct().withColumn("used", F.lit(True))
        drawn = stored(
            drawn.join(used, ["part", "surrogate"], "left").withColumn(
                "free", F.col("free") & F.col("used").isNull()
            ).drop("used"),
            "pii-draws",
        )
        won = drawn.filter("free").select("part", "value", "surrogate")
        taken = won if taken is None else taken.unionByName(won)
        left = drawn.filter("NOT free").select("part", "value", "gender")
        if left.isEmpty():
            return taken
    raise ValueError("too many different values for one type of entity")


def _cased(entity: Column, text: Column) -> Column:
    """`text`, which is in lower case, in the case of `entity`."""
    return (
        F.when((F.upper(entity) == entity) & (F.lower(entity) != entity), F.upper(text))
        .when(F.substring(entity, 1, 1) != F.lower(F.substring(entity, 1, 1)), F.initcap(text))
        .otherwise(text)
    )


def _filled(entity: Column, digits: Column) -> Column:
    """`entity` with its digits replaced in order."""
    chars = F.split(entity, "")
    place = F.aggregate(
        chars,
        F.struct(F.lit("").alias("t"), F.lit(0).alias("n"), digits.alias("d")),  # once a row, not a character
        lambda a, c: F.when(
            c.rlike("[0-9]"),
            F.struct(
                F.concat(a["t"], F.substr(a["d"], a["n"] + 1, F.lit(1))).alias("t"),
                (a["n"] + 1).alias("n"),
                a["d"].alias("d"),
            ),
        ).otherwise(F.struct(F.concat(a["t"], c).alias("t"), a["n"].alias("n"), a["d"].alias("d"))),
    )
    return place["t"]


def _replacements(entities: DataFrame, key: str) -> DataFrame:
    """(entity, kind, replacement) for distinct `entities` (entity, kind)."""
    parts = entities.select("entity", "kind", F.posexplode(_parts(F.col("kind"), F.col("entity"))).alias("at", "p"))
    parts = stored(parts.select("entity", "kind", "at", "p.*"), "pii-parts")
    # A given name that different forms of address contradict is neither male nor female.
    distinct = parts.groupBy("part", "value").agg(F.signum(F.sum("gender")).cast("int").alias("gender"))
    made = surrogates(stored(distinct, "pii-distinct"), key)
    put = (
        parts.join(made, ["part", "value"])
        .groupBy("entity", "kind")
        .agg(F.array_sort(F.collect_list(F.struct("at", "surrogate")))["surrogate"].alias("s"))
    )
    entity, s, kind = F.col("entity"), F.col("s"), F.col("kind")
    words = F.split(entity, " ")
    digits, card = _digits(entity), _card(entity)
    name = F.concat_ws(
        " ", words[0], F.zip_with(F.slice(words, 2, F.size(words)), s, lambda w, x: _cased(w, x))
    )
    text = (
        F.when(kind == "email", _cased(entity, F.concat_ws("@", s)))
        .when(kind == "name", name)
        .when(kind.isin("phone", "personal"), _filled(entity, _digits(s[0])))
        .when(kind == "card", _filled(entity, F.concat(
            F.substr(digits, F.lit(1), card["at"]), s[0], F.substr(digits, card["at"] + card["size"] + 1)
        )))
        .when(kind == "secret", F.when(F.upper(entity) == entity, F.upper(s[0])).otherwise(s[0]))
        .otherwise(s[0])
    )
    return put.select("entity", "kind", text.alias("replacement"))


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """`docs` (doc_id, text, any other columns) with entities of the texts replaced, n_entities and kinds.

    kinds are the types found, sorted and comma-joined. Entities are e-mail and IPv4 addresses, telephone
    and personal numbers, card numbers with a right check digit, secrets and names after a form of address.
    The same entities and `key` give the same surrogates, but for those drawn anew, which depend on what else
    occurs. Null and empty texts and texts without entities stay as they are with n_entities 0 and kinds "".
    Repeated rows are changed alike. Columns n_entities and kinds of `docs` are replaced. No rows give none.
    """
    text = F.col("text")
    marked = docs.drop("n_entities", "kinds").withColumn("_id", F.col("doc_id").cast("string"))
    marked = marked.withColumn("_th", F.xxhash64("text"))
    seen = (
        marked.filter(text.rlike(HINT))
        .select("_id", "_th", F.regexp_extract_all("text", F.lit(PATTERN), 0).alias("found"))
        .filter(F.size("found") > 0)
        .dropDuplicates(["_id", "_th"])
    )
    seen = stored(seen, "pii-seen")
    each = seen.select("_id", "_th", F.posexplode("found").alias("at", "entity"))
    entities = each.select("entity").distinct().withColumn("kind", _kind(F.col("entity")))
    put = stored(_replacements(stored(entities.filter("kind IS NOT NULL"), "pii-entities"), key), "pii-put")
    lists = (
        each.join(put, "entity", "left")
        .groupBy("_id", "_th")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("at", F.coalesce("replacement", "entity").alias("put")))
            )["put"].alias("_put"),
            F.count("kind").cast("int").alias("n_entities"),
            F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"),
        )
    )
    lists = stored(lists.filter("n_entities > 0"), "pii-lists")
    maybe, rest = split_by(marked, lists, "_id", "_th")
    lists = lists.withColumnsRenamed({"_id": "_lid", "_th": "_lth"})
    joined = maybe.join(lists, F.col("_id").eqNullSafe(F.col("_lid")) & (F.col("_th") == F.col("_lth")), "left")
    between = F.split("text", PATTERN, -1)
    changed = F.array_join(F.zip_with(between, "_put", lambda b, p: F.concat(b, F.coalesce(p, F.lit("")))), "")
    joined = (
        joined.withColumn("text", F.when(F.col("_put").isNull(), text).otherwise(changed))
        .withColumn("n_entities", F.coalesce("n_entities", F.lit(0)))
        .withColumn("kinds", F.coalesce("kinds", F.lit("")))
    )
    rest = rest.withColumn("n_entities", F.lit(0)).withColumn("kinds", F.lit(""))
    order = [*[c for c in docs.columns if c not in ("n_entities", "kinds")], "n_entities", "kinds"]
    return joined.select(*order).unionByName(rest.select(*order))
