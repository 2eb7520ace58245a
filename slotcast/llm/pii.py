"""Personal data: mentions are found and replaced by keyed surrogates of the same kind and form.

Kinds: e-mail addresses, phone numbers, IPv4 and IPv6 addresses, card and account numbers (IBAN),
social security numbers, secrets (long hexadecimal runs, well-known key prefixes, private key
blocks, values after ``password=``) and persons named after a title, also in capitals. The title
gives the gender; Dr and Prof alone say nothing, and such a name has the gender that another
title gives it in the same text, else none. Each name found so is a mention wherever it stands
in the same text as a whole word, as written or in capitals, but a month's name is left alone
where it stands as a month; one that is both given name and surname there takes the surname's
surrogate. Names that no title introduces in their text are not recognised.

1. One regular expression finds the mentions; only distinct (text hash, mention) pairs leave
   the scan. Mentions become parts, parts become entities: (kind, canonical form).
2. Every entity gets a candidate from a keyed hash of its canonical form and an attempt
   number. A candidate that equals an entity of the corpus or a surrogate already given is
   refused, of several equal ones the smallest entity has it; the refused try again, from
   ``GROW`` attempts on with longer values, so the rounds end even where a form is used up.
   Equal entities share a surrogate in all documents, different ones never do.
3. Mentions are rebuilt in their own layout (separators, country code, letter case, title),
   and the texts that hold any are rebuilt around them. All of it is Spark SQL; texts without
   mentions are neither shuffled nor changed.

The key is the secret that ties surrogates to entities. It is given as a parameter or in the
session as ``spark.slotcast.surrogate.key``; where neither is set, a random one is drawn for
the session, so nobody can compute the surrogates again, nor join them with another run's.

Phone numbers are told apart by their national digits: a country code, by the numbering plan's
prefixes, and a trunk zero stay as they are. Runs of 13 to 19 digits are card numbers if they
have 16 digits, stand in groups of four, or begin like a card and have a right check digit.
Card numbers keep their first digit and whether their check digit is right, IBANs their country,
where letters stand, and whether their check digits are right. Names keep gender
(by title), script (Latin or Cyrillic) and capitals; given names and surnames are replaced
each by themselves, so "Mr Roe" and "Mr Jan Roe" stay the same man.

Defined results: a null text stays null, an empty one empty, with no entities; texts of any
length are read whole. Repeated rows and texts are replaced alike. Other columns, whatever their
names, pass unchanged (``count`` names one that receives the new length where the text changed).
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from slotcast.session import materialize

GROW = 6
KEY_SETTING = "spark.slotcast.surrogate.key"

LOCAL = r"[\p{L}\p{N}._%+\-]"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Titles by the gender they give, months, and the country codes of the numbering plan.
TITLES = {"m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "M.", "Господин"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Mlle", "Госпожа"),
          "u": ("Dr", "Prof")}
TITLES = {g: (*titles, *(t.upper() for t in titles if len(t) > 2 or t in ("Mr", "Ms", "Dr", "Sr"))) for g, titles in TITLES.items()}
MONTHS = ("march", "april", "may", "june", "july", "august", "januar", "mai", "juni", "juli", "mars", "avril", "juin", "août", "abril", "mayo", "junio", "julio", "agosto")
BEFORE_MONTH = ("in", "since", "until", "till", "during", "by", "of", "from", "to", "and", "last", "next", "this", "early", "late", "mid", "im", "seit", "bis", "en", "de")
COUNTRY = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"


def _any_title(titles) -> str:
    return "(?:" + "|".join(t.replace(".", r"\.") for t in sorted(titles, key=len, reverse=True)) + r")\.? "


# A possessive ending is not part of a name.
NAME = r"\p{Lu}(?:\p{L}|['’\-](?=\p{L})(?![sS](?!\p{L}))){1,200}"
TITLE = f"(?:{_any_title(TITLES['m'] + TITLES['f'] + TITLES['u'])}){{1,3}}"
HEX = "[0-9A-Fa-f]"
ASSIGNED = r"[Pp](?:[Aa][Ss][Ss](?:[Ww][Oo][Rr][Dd]|[Ww][Dd])|[Ww][Dd])[\"']? ?[=:] ?[\"']?"
BLOCK = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
# Every pattern starts with a look behind and has bounded runs, so a very long word costs no more than its length.
PATTERNS = {
    "email": rf"(?<!{LOCAL}){LOCAL}{{1,64}}+@(?:[\p{{L}}\p{{N}}\-]{{1,63}}\.){{1,8}}\p{{L}}{{2,24}}",
    "block": BLOCK + r"[A-Za-z0-9+/=\s,:\-]{1,20000}?-----END [A-Z ]{0,40}PRIVATE KEY-----",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,}+)(?![0-9A-Za-z])",
    "password": rf"(?<![A-Za-z]){ASSIGNED}(?=[^\s\"',;]{{0,200}}[0-9!@#$%^&*])[^\s\"',;]{{6,200}}",
    "ip6": (rf"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]{{0,39}}[0-9])(?:(?:{HEX}{{1,4}}:){{7}}{HEX}{{1,4}}|(?:{HEX}{{1,4}}:){{1,6}}(?::{HEX}{{1,4}}){{1,6}})"
            r"(?![0-9A-Za-z:])"),
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![\d.])(?:\d{16}|[2-6]\d{12,18}|[3-6]\d{3}([ \-])\d{4}\1\d{4}\1\d{4})(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[\-. ]\d{4}|\d{3}[\-. ]\d{3}[\-. ]\d{4}|0\d(?:[ .]\d{2}){4}|0\d{1,4}[ /]\d{3,4}(?: ?\d{2,4}){1,2})(?!\d)",
    "person": rf"(?<![\p{{L}}\p{{N}}]){TITLE}{NAME}(?: {NAME})?",
}
MENTION = "|".join(f"(?:{p})" for p in PATTERNS.values())
# What every mention holds at least one of, a digit or @ or one of these; plain searches spare most texts the full pattern.
HINTS = (*TITLES["m"], *TITLES["f"], *TITLES["u"], "AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "PRIVATE KEY")
HINTS = tuple(w for w in HINTS if not any(o != w and o in w for o in HINTS))

SYLLABLES = {"l": "ba be bo da de do fa fe fi ga ge go la le lo ma me mo na ne no ra re ro sa se so ta te to va ve".split(),
             "c": "ба бе бо да де до фа фе фи га ге го ла ле ло ма ме мо на не но ра ре ро са се со та те то ва ве".split()}
ENDINGS = {"lsurname": "ner son ler mann ton field berg stad".split(), "csurname": "нко чук вич ров лин ский тов дин".split(),
           "lm": "rik lan mir ton bert nard gar vin".split(), "lf": "ria lina dora nia lia netta tessa vina".split(),
           "cm": "слав мир лан рик тон вин лад дар".split(), "cf": "рия лина дора ния лия вина тина дана".split(),
           "lu": "ory ael ine emi ari ely any oly".split(), "cu": "аля уня оша эни ики оло ути аро".split()}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _chars(text: str) -> str:
    return f"transform(sequence(1, length({text})), i -> substr({text}, i, 1))"


def _luhn(digits: str) -> str:
    """Check sum of a string of digits; 0 where the check digit is right."""
    return (f"(aggregate(transform(reverse({_chars(digits)}), (c, i) -> IF(i % 2 = 0, INT(c), "
            "IF(INT(c) > 4, INT(c) * 2 - 9, INT(c) * 2))), 0, (a, v) -> a + v) % 10)")


def _mod97(iban: str) -> str:
    """Remainder of an account number by ISO 7064; 1 where its check digits are right."""
    value = "IF(x RLIKE '[0-9]', INT(x), ascii(x) - 55)"
    return (f"aggregate({_chars(f'concat(substr({iban}, 5), substr({iban}, 1, 4))')}, 0, "
            f"(a, x) -> (a * IF(x RLIKE '[0-9]', 10, 100) + {value}) % 97)")


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def mentions_of(text: str) -> str:
    return f"regexp_extract_all({text}, {_quoted(MENTION)}, 0)"


def _kind(mention: str) -> str:
    """Kind of a whole mention: the first pattern that it matches from end to end."""
    cases = " ".join(f"WHEN {mention} RLIKE {_quoted('^(?:' + p + ')$')} THEN '{k}'" for k, p in PATTERNS.items())
    return f"CASE {cases} END"


def _title(mention: str) -> str:
    return f"regexp_extract({mention}, {_quoted('^' + TITLE)}, 0)"


def with_gender(found: DataFrame) -> DataFrame:
    """(h, mention) with ``g``, the gender of a person: by the title, else by another title of the given name in the same text, else 'u'."""
    def given(g: str) -> str:
        return _quoted(f"(?:^| ){_any_title(TITLES[g])}")

    title = found.withColumn("t", F.expr(f"IF(mention RLIKE {_quoted('^(?:' + PATTERNS['person'] + ')$')}, {_title('mention')}, NULL)"))
    own = title.withColumn("own", F.expr(f"CASE WHEN t RLIKE {given('f')} THEN 'f' WHEN t RLIKE {given('m')} THEN 'm' END")).withColumn(
        "first", F.expr("lower(split(substr(mention, length(t) + 1), ' ')[0])"))
    same = Window.partitionBy("h", "first")  # the distinct mentions of one name in one text
    return own.withColumn("g", F.when(F.col("t").isNotNull(), F.coalesce("own", F.min("own").over(same), F.lit("u")))).select("h", "mention", "g")


def _parts(mentions: DataFrame) -> DataFrame:
    """``mention, g, at, k, c, p``: the pieces p of a mention with kind and canonical form; literal ones have neither."""
    national = f"regexp_replace({_digits('mention')}, IF(mention LIKE '+%', '^(?:{COUNTRY})', '^$'), '')"
    one = "array(struct({k} AS k, {c} AS c, mention AS p))"
    literal = one.format(k="CAST(NULL AS STRING)", c="CAST(NULL AS STRING)")
    before = f"regexp_extract(mention, {_quoted('^' + ASSIGNED)}, 0)"
    plain = f"kind = 'card' AND mention RLIKE '^[0-9]+$' AND length(mention) <> 16 AND {_luhn('mention')} <> 0"
    return (mentions
            .withColumn("kind", F.expr(_kind("mention")))
            .withColumn("title", F.expr(f"IF(kind = 'person', {_title('mention')}, '')"))
            .withColumn("names", F.expr("split(substr(mention, length(title) + 1), ' ')"))
            .withColumn("parts", F.expr(f"""CASE
                WHEN {plain} THEN {literal}
                WHEN kind IN ('email', 'ip6') THEN {one.format(k="kind", c="lower(mention)")}
                WHEN kind = 'password' THEN array(
                    struct(CAST(NULL AS STRING) AS k, CAST(NULL AS STRING) AS c, {before} AS p),
                    struct(kind AS k, substr(mention, length({before}) + 1) AS c, substr(mention, length({before}) + 1) AS p))
                WHEN kind IN ('secret', 'ip', 'block') THEN {one.format(k="kind", c="mention")}
                WHEN kind = 'iban' THEN {one.format(k="kind", c="replace(mention, ' ', '')")}
                WHEN kind = 'phone' THEN {one.format(k="kind", c=f"regexp_replace({national}, '^0', '')")}
                WHEN kind = 'person' THEN concat(
                    array(struct(CAST(NULL AS STRING) AS k, CAST(NULL AS STRING) AS c, title AS p)),
                    transform(names, (n, i) -> struct(
                        concat(IF(n RLIKE {_quoted("^" + chr(92) + "p{IsCyrillic}")}, 'c', 'l'), IF(i = size(names) - 1, 'surname', g)) AS k,
                        lower(n) AS c, concat(IF(i = 0, '', ' '), n) AS p)))
                WHEN kind IS NULL THEN {literal}
                ELSE {one.format(k="kind", c=_digits("mention"))} END"""))
            .selectExpr("mention", "g", "posexplode(parts) AS (at, part)")
            .selectExpr("mention", "g", "at", "part.k", "part.c", "part.p"))


def _candidate(key: str) -> str:
    """SQL for the surrogate of entity (k, c) at its attempt."""
    def hashed(i: int) -> str:
        return f"sha2(concat_ws('|', {_quoted(key)}, k, c, attempt, {i}), 256)"

    digits = f"translate(concat({hashed(0)}, {hashed(1)}), 'abcdef', '012345')"
    letters = f"translate(concat({hashed(0)}, {hashed(1)}), '0123456789abcdef', 'bcdfghjklmnpqrst')"
    cyrillic = f"translate({hashed(0)}, '0123456789abcdef', 'абвгдежзиклмнопр')"
    more = f"substr({{}}, 65, greatest(attempt - {GROW} + 1, 0))"
    octets = ", ".join(f"INT(conv(substr({hashed(0)}, {at}, 2), 16, 10))" for at in (3, 5, 7))
    card = f"concat(substr(c, 1, 1), substr({digits}, 1, length(c) - 2))"
    check = f"(10 - {_luhn(f'concat({card}, 0)')}) % 10"
    wrong = f"({check} + 1 + INT(substr({digits}, 40, 1)) % 9) % 10"
    body = (f"concat(array_join(transform({_chars('substr(c, 5)')}, (x, i) -> IF(x RLIKE '[0-9]', substr({digits}, i + 1, 1), "
            f"upper(substr({letters}, i + 1, 1)))), ''), {more.format(digits)})")
    zero = f"concat(substr(c, 1, 2), '00', {body})"
    # One beside the right check digits is wrong.
    account = f"concat(substr(c, 1, 2), lpad(STRING(98 - {_mod97(zero)} - IF({_mod97('c')} = 1, 0, IF({_mod97(zero)} > 90, -1, 1))), 2, '0'), {body})"
    local = (f"array_join(transform({_chars('split(c, chr(64))[0]')}, (x, i) -> CASE WHEN x RLIKE '[0-9]' THEN substr({digits}, i % 60 + 1, 1) "
             f"WHEN x RLIKE {_quoted(chr(92) + 'p{IsCyrillic}')} THEN substr({cyrillic}, i % 60 + 1, 1) "
             f"WHEN x RLIKE {_quoted(chr(92) + 'p{L}')} THEN substr({letters}, i % 60 + 1, 1) ELSE x END), '')")
    domain = f"sha2(concat_ws('|', {_quoted(key)}, 'domain', split(c, chr(64))[1]), 256)"
    domain = (f"concat(substr(translate({domain}, '0123456789abcdef', 'bcdfghjklmnpqrst'), 1, 8), '.example.', "
              "coalesce(nullif(regexp_extract(c, '[.](com|net|org)$', 1), ''), 'org'))")

    def name(script: str, kind: str) -> str:
        def pick(words, at):
            return f"array({', '.join(map(_quoted, words))})[INT(conv(substr({hashed(0)}, {at}, 4), 16, 10)) % {len(words)}]"

        first = f"concat({pick(SYLLABLES[script], 1)}, {pick(SYLLABLES[script], 5)}, {pick(ENDINGS[script + kind], 9)})"
        longer = (f"array_join(transform(sequence(1, greatest(attempt - {GROW} + 1, 1)), i -> array({', '.join(map(_quoted, SYLLABLES[script]))})"
                  f"[INT(conv(substr({hashed(1)}, i % 16 * 4 + 1, 4), 16, 10)) % {len(SYLLABLES[script])}]), '')")
        return f"IF(attempt < {GROW}, {first}, concat({first}, '-', {longer}))"

    names = " ".join(f"WHEN '{s}{n}' THEN {name(s, n)}" for s in "lc" for n in ("surname", "m", "f", "u"))
    hexes = f"concat({hashed(0)}, {hashed(1)})"
    many = f"repeat({hexes}, INT(length(c) / 128) + 1)"
    mixed = (f"array_join(transform({_chars('c')}, (x, i) -> CASE WHEN x RLIKE '[0-9]' THEN substr({digits}, i % 60 + 1, 1) "
             f"WHEN x RLIKE '[A-Z]' THEN upper(substr({letters}, i % 60 + 1, 1)) WHEN x RLIKE '[a-z]' THEN substr({letters}, i % 60 + 1, 1) ELSE x END), '')")
    head = f"regexp_extract(c, {_quoted('^' + BLOCK)}, 0)"
    tail = "regexp_extract(c, '-----END [A-Z ]{0,40}PRIVATE KEY-----$', 0)"
    inner = f"substr(c, length({head}) + 1, length(c) - length({head}) - length({tail}))"
    key_block = (f"concat({head}, array_join(transform({_chars(inner)}, (x, i) -> IF(x RLIKE '[0-9A-Za-z+/]', substr({hexes}, i % 128 + 1, 1), x)), ''), {tail})")
    return f"""CASE k
        WHEN 'ip6' THEN array_join(transform({_chars('c')}, (x, i) -> IF(x = ':', x, substr({hexes}, i + 1, 1))), '')
        WHEN 'password' THEN concat({mixed}, {more.format(letters)})
        WHEN 'block' THEN {key_block}
        WHEN 'email' THEN concat({local}, {more.format(letters)}, '@', {domain})
        WHEN 'ip' THEN concat_ws('.', 11 + INT(conv(substr({hashed(0)}, 1, 2), 16, 10)) % 100, {octets}, nullif({more.format(digits)}, ''))
        WHEN 'card' THEN concat({card}, IF({_luhn('c')} = 0, {check}, {wrong}), {more.format(digits)})
        WHEN 'iban' THEN {account}
        WHEN 'secret' THEN concat(CASE
            WHEN c RLIKE '^[0-9a-f]+$' THEN substr({many}, 1, length(c))
            WHEN c RLIKE '^[0-9A-F]+$' THEN upper(substr({many}, 1, length(c)))
            WHEN c RLIKE '^AKIA' THEN concat('AKIA', upper(substr({letters}, 1, 16)))
            WHEN c RLIKE '^gh' THEN concat(substr(c, 1, 4), substr({letters}, 1, 36))
            ELSE concat('sk-', substr(repeat({letters}, INT(length(c) / 64) + 1), 1, length(c) - 3)) END, {more.format(hexes)})
        {names}
        ELSE concat(substr({digits}, 1, length(c)), {more.format(digits)}) END"""


def session_key(spark: SparkSession) -> str:
    """The session's key; a random one is drawn where none is set."""
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark.conf.get(KEY_SETTING)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``k, c, s`` for every entity (k, c): distinct per kind, and equal to no entity of the kind."""
    entities = materialize(entities.select("k", "c").distinct())
    pending, given = entities.withColumn("attempt", F.lit(0)), None
    while True:
        tried = pending.withColumn("s", F.expr(_candidate(key)))
        free = tried.join(entities.select(F.col("k").alias("o_k"), F.col("c").alias("o_c")), F.expr("k = o_k AND s = o_c"), "left_anti")
        if given is not None:
            free = free.join(given.select("k", "s"), ["k", "s"], "left_anti")
        won = materialize(free.groupBy("k", "s").agg(F.min("c").alias("c")))
        given = won if given is None else given.unionAll(won)
        pending = materialize(pending.join(won.select("k", "c"), ["k", "c"], "left_anti").withColumn("attempt", F.col("attempt") + 1))
        if pending.isEmpty():
            return given.select("k", "c", "s")


def replacements(mentions: DataFrame, key: str) -> DataFrame:
    """``mention, g, replacement, names`` for distinct (mention, g); names are those in it with their surrogates."""
    parts = materialize(_parts(mentions))
    given = surrogates(parts.where("k IS NOT NULL"), key).selectExpr("k AS s_k", "c AS s_c", "s")
    joined = parts.join(given, F.expr("k = s_k AND c = s_c"), "left")
    # Digits of the surrogate take the places of the canonical digits, counted from the right.
    place = f"length({_digits('substr(p, 1, i + 1)')}) - length({_digits('p')}) + length(c)"
    laid_out = (f"concat(array_join(transform({_chars('p')}, (x, i) -> IF(x RLIKE '[0-9]' AND {place} >= 1, substr(s, {place}, 1), x)), ''), "
                "substr(s, length(c) + 1))")
    spaced = ("concat(array_join(transform({0}, (x, i) -> IF(x = ' ', ' ', substr(s, length(replace(substr(p, 1, i + 1), ' ', '')), 1))), ''), "
              "substr(s, length(c) + 1))").format(_chars("p"))
    cased = "IF(length(trim(p)) > 1 AND p = upper(p), upper(s), concat(upper(substr(s, 1, 1)), substr(s, 2)))"
    built = joined.withColumn("r", F.expr(f"""CASE WHEN k IS NULL THEN p
        WHEN k IN ('phone', 'card', 'ssn') THEN {laid_out}
        WHEN k = 'iban' THEN {spaced}
        WHEN k = 'email' THEN IF(p = upper(p), upper(s), s)
        WHEN k = 'ip6' THEN IF(p = upper(p), upper(s), s)
        WHEN k IN ('secret', 'ip', 'block', 'password') THEN s
        ELSE concat(IF(p LIKE ' %', ' ', ''), {cased}) END"""))
    return built.groupBy("mention", "g").agg(F.expr(
        "array_join(transform(sort_array(collect_list(struct(at, r))), x -> x.r), '') AS replacement"), F.expr(  # four parts at most
        "collect_list(IF(k IN ('lsurname', 'lm', 'lf', 'lu', 'csurname', 'cm', 'cf', 'cu'), struct(trim(p) AS p, INT(k NOT LIKE '%surname') AS rank, trim(r) AS r), NULL)) AS names"))


def _month(name: str) -> str:
    """SQL for the pattern of a name: one that is a month's is not meant where it stands as a month."""
    before = "|".join(sorted({w for m in BEFORE_MONTH for w in (m, m.capitalize(), m.upper())}))
    months = ", ".join(map(_quoted, MONTHS))
    guard = _quoted(r"(?<!(?:(?:" + before + r")|[0-9][.]?|[0-9](?:st|nd|rd|th)) )")
    return f"IF(lower({name}) IN ({months}), concat({guard}, {name}, '(?! [0-9])'), {name})"


def replaced(docs: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """Per input row: ``row`` (the row as it was), ``clean`` (its new text) and ``n_mentions``."""
    key = key or session_key(docs.sparkSession)
    hint = " OR ".join([f"`{text}` RLIKE '[0-9@]'", f"`{text}` RLIKE {_quoted('[a-f]{32}|[A-F]{32}|' + ASSIGNED)}",
                        *[f"contains(`{text}`, {_quoted(w)})" for w in HINTS]])
    has = f"coalesce(({hint}) AND `{text}` RLIKE {_quoted(MENTION)}, false)"
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.expr(has).alias("has"))
    touched = docs.where(has).select(F.xxhash64(text).alias("h"), F.col(text).alias("body"))
    found = materialize(with_gender(touched.select("h", F.explode(F.expr(mentions_of("body"))).alias("mention")).distinct()))
    swap = replacements(found.select("mention", "g").distinct(), key).selectExpr("mention AS s_mention", "g AS s_g", "replacement", "names")
    swaps = found.join(swap, F.expr("mention = s_mention AND g <=> s_g")).where("mention <> replacement").groupBy("h").agg(
        F.map_from_entries(F.collect_set(F.struct("mention", "replacement"))).alias("swaps"),
        F.flatten(F.collect_set("names")).alias("names"))
    # A name as it is written and in capitals, once each; their pattern looks for whole words, longer names first.
    swaps = swaps.withColumn("names", F.expr(
        "sort_array(concat(names, transform(names, x -> struct(upper(x.p) AS p, x.rank + 2 AS rank, upper(x.r) AS r))))"))
    swaps = swaps.withColumn("names", F.expr("map_from_entries(transform(filter(names, (x, i) -> i = 0 OR x.p <> names[i - 1].p), x -> struct(x.p, x.r)))"))
    swaps = swaps.withColumn("known", F.expr(
        rf"""IF(size(names) = 0, NULL, concat('(?<![\\p{{L}}\\p{{N}}])(?:', array_join(transform(
        sort_array(transform(map_keys(names), n -> struct(-length(n) AS l, n))), x -> {_month("x.n")}), '|'), ')(?![\\p{{L}}\\p{{N}}])'))"""))
    dirty = rows.where("has").withColumn("t_h", F.xxhash64(f"row.`{text}`")).join(swaps, F.col("t_h") == F.col("h"), "left")
    body = f"row.`{text}`"
    dirty = dirty.select("row", "swaps", "names", "known", F.expr(f"split({body}, {_quoted(MENTION)}, -1)").alias("gaps"),
                         F.expr(mentions_of(body)).alias("found"))
    repeats = "regexp_extract_all(g, known, 0)"
    dirty = dirty.select("row", "swaps", "found", F.expr(
        f"IF(known IS NULL, gaps, transform(gaps, g -> array_join(zip_with(split(g, known, -1), {repeats}, "
        "(o, w) -> concat(o, coalesce(try_element_at(names, w), w, ''))), '')))").alias("gaps"), F.expr(
        f"IF(known IS NULL, 0, aggregate(gaps, 0, (n, g) -> n + size({repeats})))").alias("n_repeats"))
    rebuilt = "array_join(zip_with(gaps, found, (gap, m) -> concat(gap, coalesce(try_element_at(swaps, m), m, ''))), '')"
    counted = "CAST(IF(swaps IS NULL, 0, size(filter(found, m -> map_contains_key(swaps, m))) + n_repeats) AS BIGINT) AS n_mentions"
    dirty = dirty.select("row", F.expr(rebuilt).alias("clean"), F.expr(counted))
    untouched = rows.where("NOT has").select("row", F.col(f"row.`{text}`").alias("clean"), F.lit(0).cast("bigint").alias("n_mentions"))
    return dirty.unionAll(untouched)


def pseudonymise(docs: DataFrame, text: str = "text", key: str | None = None, count: str | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, with every mention replaced in the text."""
    def column(c: str):
        if c == text:
            return F.col("clean").alias(c)
        if c == count:
            return F.when(F.col("n_mentions") > 0, F.length("clean").cast(docs.schema[c].dataType)).otherwise(
                F.col(f"row.`{c}`")).alias(c)
        return F.col(f"row.`{c}`").alias(c)

    return replaced(docs, text, key).select(*map(column, docs.columns))
