"""Surrogates for personal data (operator 3), with DataFrame functions only.

Found entities are replaced by keyed surrogates of the same kind: digits become digits, letters
letters of the same script and case, separators stay, octets of an address stay octets, given
names are taken from the list of the same gender and script, and ends of mail domains stay.
A surrogate depends on the key and on the entity's canonical form (lower case, digits only), so
all its spellings in all documents stay one entity. Surrogates that meet each other or a real
entity are drawn again, until none does; different entities thus stay different. Surnames have
surrogates of their own, from which the names of all who share one are built.

Texts are cut into gaps and mentions. Distinct mentions, not texts, are shuffled to their
surrogates; a mention that occurs everywhere is one row per task after the partial ``distinct``,
and its join back may be split as a skewed one. Texts without entities are never shuffled.

Defined cases: a null text stays null, an empty one empty. All columns are kept as they are,
whatever their names, but n_entities is overwritten; rows are numbered inside the job, so repeated
rows are each rewritten. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.session import materialize

EDGE, END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
#: What may stand between two digits of a phone number, while brackets may open and after that.
CLOSED = r"(?:\)?[ .\u00a0/-]?)"
OPEN = r"(?:\)?[ .\u00a0/-]?\(?)"
NUMBER = (
    r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
    r"|[0-9]{3}-[0-9]{2}-[0-9]{4})"
)
#: No address, number or national phone number begins after a space.
OTHER = (
    r"(?! (?:(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[\p{L}\p{N}])|(?:" + NUMBER
    + r"|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})" + END + "))"
)
#: Country codes of one and two digits; all others have three.
COUNTRY = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: Patterns by type; the first that matches at a place wins. Repeats are bounded or never given back
#: and begin at the edge of a word, so a text of any kind is read in linear time and flat.
PATTERNS = {
    # No longer than mail allows: 64 characters before the sign, labels of 63 after it.
    "email": EDGE
    + r"[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]{1,63}+(?:\.[\p{L}\p{N}-]{1,63}+){1,126}+",
    "ip": EDGE + r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}" + END,
    # After a plus sign 7 to 15 digits in any groups, with North America's 10 after its 1; where they
    # could end, another entity is not taken in. Else the national forms of North America.
    "phone": (
        r"\+1(?:" + OPEN + r"[0-9]){10}" + END
        + r"|\+[0-9](?:" + OPEN + r"[0-9]){6}(?:" + OTHER + CLOSED + r"[0-9]){0,8}" + END
        + r"|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}" + END
        + "|" + EDGE + r"[0-9]{3}(?<sep>[.-])[0-9]{3}\k<sep>[0-9]{4}" + END
    ),
    "number": EDGE + NUMBER + END,
    "account": EDGE + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + END,
    "secret": EDGE + r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})" + END,
    "name": (
        EDGE
        + r"(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sra|Господин|Госпожа)\.? "
        + r"\p{Lu}[\p{L}'-]++(?: \p{Lu}[\p{L}'-]++){0,2}"
    ),
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Cheap test for texts that cannot hold an entity.
HINT = r"[0-9@]|(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sra|Господин|Госпожа)\.? "
LONGER = 8  # turns after which surrogates get one character or syllable more
MALE = r"^(?:Mr|Herr|Monsieur|Señor|Господин)$"

#: Given names by script and gender; surnames are made from syllables.
GIVEN = {
    ("latin", "m"): "Adam Boris Carlo Daniel Emil Felix Gustav Hugo Ivan Jonas Karl Leon Marco "
    "Nils Oscar Paul Rafael Simon Tomas Victor".split(),
    ("latin", "f"): "Alma Berta Clara Diana Elena Flora Greta Helena Irma Julia Karin Laura Maria "
    "Nora Olivia Paula Rosa Sofia Teresa Vera".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Ксения Лариса Мария Нина".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to "
    "va ve vo".split(),
    "cyrillic": "ба бе бо ва ве во га ге го да де до ка ке ко ла ле ло ма ме мо на не но ра ре "
    "ро са".split(),
}
ALPHABETS = {
    r"[0-9]": "0123456789",
    r"[a-z]": "abcdefghijklmnopqrstuvwxyz",
    r"[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшщэюя",
    r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω",
    r"\p{IsHan}": "一二三四五六七八九十天地日月山水火木金土人口手目耳心",
    r"\p{IsLatin}": "àáâäçèéêëíîïñóôöùúûüß",
}


def kind(mention: Column) -> Column:
    """Type of a mention, by the pattern it matches as a whole, in order."""
    out = F.lit("name")
    for name, pattern in reversed(list(PATTERNS.items())[:-1]):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


def canonical(mention: Column, what: Column) -> Column:
    """What spellings of one entity share."""
    digits = F.regexp_replace(mention, r"[^0-9]", "")
    # The country's part stays apart, however the digits are grouped; numbers without one are
    # taken as North American.
    phone = F.when(~mention.startswith("+"), F.concat(F.lit("1 "), digits)).otherwise(
        F.regexp_replace(digits, COUNTRY, "$1 ")
    )
    return (
        F.when(what == "phone", phone)
        .when(what == "number", digits)
        .when(what == "account", F.regexp_replace(mention, " ", ""))
        .otherwise(F.lower(mention))
    )


def _draw(seed: Column, place: Column, size: int | Column) -> Column:
    """A number below ``size`` from hexadecimal digits of a keyed hash."""
    block = F.sha2(F.concat_ws("|", seed, F.floor(place / 8).cast("string")), 256)
    digits = F.substring(block, F.pmod(place, F.lit(8)).cast("int") * 8 + 1, F.lit(8))
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(size) if isinstance(size, int) else size)


def _pick(choices: list[str] | str, at: Column) -> Column:
    listed = F.array(*[F.lit(c) for c in choices])
    return F.element_at(listed, (at + 1).cast("int"))


def _letters(value: Column, seed: Column, hexadecimal: bool = False) -> Column:
    """Every letter and digit drawn anew from its own alphabet, the rest as it is."""

    def one(char: Column, place: Column) -> Column:
        out = char
        for pattern, alphabet in reversed(ALPHABETS.items()):
            first = place == 0
            if hexadecimal:
                alphabet = "0123456789abcdef" if pattern in ("[0-9]", "[a-z]") else "0123456789ABCDEF"
            drawn = _pick(alphabet, _draw(seed, place, len(alphabet)))
            if pattern == "[0-9]" and not hexadecimal:
                # No leading zero where there was none.
                drawn = F.when(
                    first & (char != "0"), _pick("123456789", _draw(seed, place, 9))
                ).otherwise(drawn)
            out = F.when(char.rlike(pattern), drawn).otherwise(out)
        return out

    chars = F.split(value, "")
    return F.array_join(F.transform(chars, one), "")


def _email(value: Column, seed: Column) -> Column:
    """A new local part and new domain labels; the last label stays."""
    body, last = F.regexp_extract(value, r"^(.*\.)([^.]+)$", 1), F.regexp_extract(value, r"([^.]+)$", 1)
    return F.concat(_letters(body, seed), last)


def _phone(value: Column, seed: Column) -> Column:
    """The country's part stays."""
    country = F.regexp_extract(value, r"^([0-9]{1,3} )?", 1)
    return F.concat(country, _letters(F.regexp_replace(value, r"^[0-9]{1,3} ", ""), seed))


def _ip(seed: Column) -> Column:
    octets = [(1 + _draw(seed, F.lit(k), 254)).cast("string") for k in range(4)]
    return F.concat_ws(".", *octets)


def _family(value: Column, seed: Column, length: int) -> Column:
    """A surname of ``length`` syllables in the script of ``value``."""

    def drawn(script: str) -> Column:
        listed = SYLLABLES[script]
        return F.concat(*[_pick(listed, _draw(seed, F.lit(k), len(listed))) for k in range(length)])

    return F.when(value.rlike(r"\p{IsCyrillic}"), drawn("cyrillic")).otherwise(drawn("latin"))


def family(name: Column) -> Column:
    """The last word of a name."""
    return F.element_at(F.split(name, " "), -1)


def _name(value: Column, new_family: Column, word_seed: Column, parts: int) -> Column:
    """Title kept; given names by gender and script, ``parts`` of them in place of each, and the
    surname that all who share it get."""
    words = F.split(value, " ")
    title = F.regexp_replace(F.initcap(words[0]), r"\.$", "")
    male = title.rlike(MALE)
    cyrillic = value.rlike(r"\p{IsCyrillic}")

    def given(own: Column, script: str, gender: str) -> Column:
        listed = GIVEN[script, gender]
        drawn = [_pick(listed, _draw(own, F.lit(k), len(listed))) for k in range(parts)]
        return F.lower(F.concat_ws("-", *drawn))

    def first(text: Column) -> Column:
        own = F.concat_ws("|", word_seed, text)
        return F.when(
            cyrillic & male, given(own, "cyrillic", "m")
        ).when(cyrillic, given(own, "cyrillic", "f")).when(
            male, given(own, "latin", "m")
        ).otherwise(given(own, "latin", "f"))

    between = F.transform(F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0))), first)
    return F.array_join(F.concat(F.slice(words, 1, 1), between, F.array(new_family)), " ")


def _surrogate(
    what: Column, value: Column, new_family: Column, seed: Column, word_seed: Column, turn: int
) -> Column:
    """A draw for one entity; where short values leave no room, later turns draw longer ones."""
    longer = turn // LONGER
    return (
        F.when(what == "email", _email(value, seed))
        .when(what == "ip", _ip(seed))
        .when(what == "phone", _phone(value, seed))
        .when(what == "secret", _letters(value, seed, hexadecimal=True))
        .when(what == "family", _family(value, seed, 4 + longer))
        .when(what == "name", _name(value, new_family, word_seed, 1 + longer))
        .otherwise(_letters(F.concat(value, F.lit("0" * longer)), seed))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """type, canonical, surrogate of distinct entities; no surrogate is shared or real.

    Surnames are drawn first, once each: whoever has one keeps it in all forms of the name, and a
    name that meets another is drawn again in its given names alone.
    """
    named = entities.where(F.col("type") == "name").select(family(F.col("canonical")).alias("family"))
    families = named.distinct().select(F.lit("family").alias("type"), F.col("family").alias("canonical"))
    new = _distinct_draws(families.withColumn("new_family", F.lit(None).cast("string")), key)
    new = new.select(F.col("canonical").alias("family"), F.col("surrogate").alias("new_family"))
    own = F.when(F.col("type") == "name", family(F.col("canonical")))
    whole = entities.select("type", "canonical", own.alias("family")).join(new, "family", "left")
    return _distinct_draws(materialize(whole.drop("family"), "entities"), key)


def _distinct_draws(entities: DataFrame, key: str) -> DataFrame:
    """type, canonical, surrogate of ``entities`` (type, canonical, new_family)."""
    real = entities.select("type", F.col("canonical").alias("surrogate"))
    done, turn = None, 0
    open_rows = entities
    while True:
        seed = F.concat_ws("|", F.lit(key), F.lit(str(turn)), "type", "canonical")
        word_seed = F.concat_ws("|", F.lit(key), F.lit(str(turn)))
        drawn = materialize(
            open_rows.withColumn(
                "surrogate",
                _surrogate(
                    F.col("type"), F.col("canonical"), F.col("new_family"), seed, word_seed, turn
                ),
            ),
            "drawn",
        )
        holder = drawn.groupBy("type", "surrogate").agg(F.min("canonical").alias("holder"))
        free = holder.join(real, ["type", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        kept = drawn.join(free, ["type", "surrogate"]).where("canonical = holder")
        kept = materialize(kept.select("type", "canonical", "surrogate"), "kept")
        done = kept if done is None else done.unionAll(kept)
        open_rows = drawn.join(kept, ["type", "canonical"], "left_anti").drop("surrogate")
        open_rows = materialize(open_rows, "again")
        turn += 1
        if open_rows.isEmpty():
            return done


def _in_format(mention: Column, surrogate: Column) -> Column:
    """Letters and digits of a surrogate in the separators and cases of a mention."""
    letters = F.regexp_replace(surrogate, r"[^\p{L}\p{N}]", "")
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def step(held: Column, char: Column) -> Column:
        drawn = F.substring(letters, held["next"], F.lit(1))
        cased = F.when(char.rlike(r"\p{Lu}"), F.upper(drawn)).otherwise(drawn)
        taken = F.struct(
            F.concat(held["out"], cased).alias("out"), (held["next"] + 1).alias("next")
        )
        left = F.struct(F.concat(held["out"], char).alias("out"), held["next"].alias("next"))
        return F.when(char.rlike(r"[\p{L}\p{N}]"), taken).otherwise(left)

    # A surrogate that had to be longer ends with what is left.
    whole = lambda held: F.concat(held["out"], F.substring(letters, held["next"], F.length(letters)))
    return F.aggregate(F.split(mention, ""), start, step, whole)


def replacements(mentions: DataFrame, key: str) -> DataFrame:
    """mention, replacement for distinct mentions."""
    typed = mentions.withColumn("type", kind(F.col("mention")))
    typed = materialize(
        typed.withColumn("canonical", canonical(F.col("mention"), F.col("type"))), "mentions"
    )
    entities = materialize(typed.select("type", "canonical").distinct(), "entities")
    foreign = (F.col("type") == "phone") & ~F.col("mention").startswith("+")
    drawn = F.when(foreign, F.regexp_replace("surrogate", "^1 ", "")).otherwise(F.col("surrogate"))
    named = typed.join(surrogates(entities, key), ["type", "canonical"])
    capitals = F.regexp_replace(F.col("mention"), r"[^\p{L}]", "").rlike(r"^\p{Lu}{2,}$")
    replaced = (
        F.when(F.col("type") == "ip", F.col("surrogate"))
        .when(F.col("type") == "name", F.when(capitals, F.upper("surrogate")).otherwise(F.initcap("surrogate")))
        .otherwise(_in_format(F.col("mention"), drawn))
    )
    return named.select("mention", replaced.alias("replacement"))


def replace_pii(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with surrogates in their texts, and n_entities (replaced mentions)."""
    others = [c for c in docs.columns if c not in (text_col, "n_entities")]
    doc = F.struct(F.lit(None).cast("int").alias("_"), *[F.col(f"`{c}`") for c in others])
    own = docs.select(doc.alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    has = F.coalesce(text.rlike(HINT) & text.rlike(ANY), F.lit(False))
    hits = materialize(
        own.where(has).select(
            F.monotonically_increasing_id().alias("row"),
            "doc",
            found.alias("mentions"),
            F.split(text, ANY, -1).alias("gaps"),
        ),
        "hits",
    )
    # Written above, so row numbers stay as they are.
    placed = hits.select("row", F.posexplode("mentions").alias("place", "mention"))
    table = replacements(placed.select("mention").distinct(), key)
    in_order = F.array_sort(F.collect_list(F.struct("place", "replacement")))
    per_text = (
        placed.join(table, "mention")
        .groupBy("row")
        .agg(in_order.getField("replacement").alias("replacements"))
    )
    joined = F.concat(
        F.array_join(
            F.zip_with(
                F.slice("gaps", 1, F.size("replacements")),
                "replacements",
                lambda gap, new: F.concat(gap, new),
            ),
            "",
        ),
        F.element_at("gaps", -1),
    )
    rewritten = hits.join(per_text, "row").select(
        "doc", joined.alias("text"), F.size("replacements").cast("bigint").alias("n_entities")
    )
    untouched = own.where(~has).select("doc", "text", F.lit(0).cast("bigint").alias("n_entities"))
    out = [F.col("text").alias(text_col) if c == text_col else F.col(f"doc.`{c}`")
           for c in docs.columns if c != "n_entities"]
    return untouched.unionByName(rewritten).select(*out, "n_entities")
