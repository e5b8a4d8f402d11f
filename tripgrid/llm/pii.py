"""Personal data replaced by keyed surrogates.

Detected entities (e-mail, card, phone, social security and IP numbers, names after a title) are
replaced by surrogates of the same type. A surrogate is a function of the key and the normalized
entity, so one entity has one surrogate wherever and however it is written (coreference), and it is
computed in the task that reads the text:

* Numbers go through a keyed Feistel permutation of their digits, so different numbers of
  one attempt stay different by construction. Signs and blanks stay in place, as do a phone's country code and a card's first
  digit; a card that passes its check digit still does, and octets stay octets.
* E-mails and names are spelled from a keyed hash: addresses keep the shape of their local part, names
  their script and the gender of their title. Given and family names are replaced word by word, so a
  person called by family name alone keeps it.

Surrogates may collide: two entities share one, or one equals an entity. A check over all distinct
entities (only these are shuffled) finds them. Of numbers and e-mails only the entities concerned are
drawn again, each with its next attempt number, until none is left; of those that share a surrogate
one keeps it. About n * n / N of n entities with N possible surrogates are drawn again. Their table
meets the mentions, which are thin rows, and only texts that mention one of them get its attempt number
along; no task holds the table unless it is small. Longer e-mails make room; numbers have room as long as fewer than half
of the numbers of a kind and head are real. Beyond that drawing would not end, so after ``MOST_DRAWS``
attempts it raises an error. Names share their words, so all names are drawn again together, with two syllables
more each time.

Names are found after one of a list of titles only: up to three words, with particles (``de la``) between them, which stay.
Latin, Cyrillic, Greek and Armenian names keep their script, and capitals stay capitals.

Null texts stay null; texts without entities stay as they are. Repeated rows are replaced alike. Empty
tables give empty ones. All other columns are kept, whatever their names, but for ``entity_counts``.
"""

from pyspark.sql import functions as F

from .common import bounded, fenced, reserved

# Titles and the gender they tell.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Госпожа", "Κυρία"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Господин", "Κύριος"),
}
_PART = r"(?:\p{Lu}['’])?\p{Lu}[\p{L}\p{M}]+"
_NAME = rf"{_PART}(?:-{_PART})?"
_PARTICLES = "(?: (?:de|del|della|di|da|du|la|las|los|le|van|von|der|den|el)){0,3}"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LOCAL = "A-Za-z0-9._%+-"
KINDS = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": "(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "card": "(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9A-Za-z])",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(t for g in TITLES.values() for t in g)})\.? {_NAME}(?:{_PARTICLES} {_NAME}){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
# What any text with an entity contains; these plain searches come first, and most texts end there.
_SIGNS = "@|[0-9]{4}|[0-9][.][0-9]"
_STEMS = ("Mr", "Ms", "Miss", "Frau", "Madame", "Mme", "Señor", "Sr", "Herr", "Monsieur", "Г-", "Господ", "Κυρία", "Κύριος")
# Syllables of spelled names by script, and the endings by gender.
SYLLABLES = {
    "latin": ("ba be bi bo da de di do fa fe fi fo ga ge gi go ka ke ki ko la le li lo ma me mi mo na ne ni no "
              "pa pe pi po ra re ri ro sa se si so ta te ti to va ve vi vo za ze zi zo"),
    "cyrillic": ("ба бе би бо да де ди до фа фе фи фо га ге ги го ка ке ки ко ла ле ли ло ма ме ми мо на не ни но "
                 "па пе пи по ра ре ри ро са се си со та те ти то ва ве ви во за зе зи зо"),
    "greek": ("βα βε βι βο γα γε γι γο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο "
              "πα πε πι πο ρα ρε ρι ρο σα σε σι σο τα τε τι το φα φε φι φο"),
    "armenian": ("բա բե բի բո գա գե գի գո դա դե դի դո կա կե կի կո լա լե լի լո մա մե մի մո նա նե նի նո "
                 "պա պե պի պո ռա ռե ռի ռո սա սե սի սո տա տե տի տո վա վե վի վո"),
}
ENDINGS = {("latin", "f"): "na", ("latin", "m"): "n", ("cyrillic", "f"): "на", ("cyrillic", "m"): "н",
           ("greek", "f"): "να", ("greek", "m"): "νος", ("armenian", "f"): "նա", ("armenian", "m"): "ն"}
# How a word shows its script; other scripts are spelled in Latin letters.
SCRIPTS = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}", "armenian": r"\p{IsArmenian}"}
# With fewer than half of all numbers real, each draw at least halves those left.
MOST_DRAWS = 64
ROUNDS = 6
# Kinds whose entities are drawn again one by one.
ONE_BY_ONE = ("email", "ip", "ssn", "phone", "card")


def _number(key, label, *parts):
    """A keyed number below 16 ** 14 from text columns; the key is one, too."""
    digest = F.sha2(F.concat_ws("\0", key, F.lit(label), *parts), 256)
    return F.conv(F.substring(digest, 1, 14), 16, 10).cast("long")


def _feistel(key, label, a, b, size_a, size_b):
    """A permutation of pairs below ``size_a`` and ``size_b`` (columns), as ``struct(a, b)``."""
    def turn(pair, i):
        odd = i % 2 == 1
        still = F.when(odd, pair["a"]).otherwise(pair["b"])
        moved = F.when(odd, pair["b"]).otherwise(pair["a"])
        size = F.when(odd, size_b).otherwise(size_a)
        new = F.pmod(moved + _number(key, label, i.cast("string"), size_a.cast("string"), size_b.cast("string"),
                                     still.cast("string")), size)
        return F.struct(F.when(odd, pair["a"]).otherwise(new).alias("a"), F.when(odd, new).otherwise(pair["b"]).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _let(value, use):
    """``use(value)`` with the value computed once: expressions are not shared inside lambdas."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def _digits(text):
    return F.regexp_replace(text, "[^0-9]", "")


def _cut(text, start, length):
    return F.substring(text, start if not isinstance(start, int) else F.lit(start), length)


def _permuted(key, label, digits):
    """Digits permuted among all texts of as many digits."""
    def permute(d):
        n = F.char_length(d)
        left = F.floor(n / 2).cast("int")
        right = n - left
        ten = [F.pow(F.lit(10.0), w).cast("long") for w in (left, right)]
        new = _feistel(key, label, F.coalesce(_cut(d, 1, left).cast("long"), F.lit(0)),
                       _cut(d, left + 1, right).cast("long"), *ten)
        return _let(new, lambda p: F.concat(
            F.when(left > 0, F.lpad(p["a"].cast("string"), left, "0")).otherwise(""),
            F.lpad(p["b"].cast("string"), right, "0")))

    return _let(digits, permute)


def _in_format(text, digits):
    """``digits`` in the places where ``text`` has digits."""
    places = F.sequence(F.lit(1), F.char_length(text))
    return _let(digits, lambda d: F.array_join(F.transform(places, lambda i: F.when(
        F.rlike(_cut(text, i, F.lit(1)), F.lit("[0-9]")),
        _cut(d, F.char_length(_digits(_cut(text, 1, i))), F.lit(1)),
    ).otherwise(_cut(text, i, F.lit(1)))), ""))


def _luhn(digits):
    """The check digit that belongs behind ``digits``."""
    n = F.char_length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + F.when(
        (n - i) % 2 == 0, _doubled(_cut(digits, i, F.lit(1)).cast("int"))).otherwise(
        _cut(digits, i, F.lit(1)).cast("int")))
    return F.pmod(-total, F.lit(10))


def _doubled(d):
    return F.when(d > 4, 2 * d - 9).otherwise(2 * d)


def _spelled(key, label, entity, alphabet, length):
    """``length`` entries of ``alphabet`` drawn by the keyed hash of a text column."""
    return F.transform(F.sequence(F.lit(1), length), lambda i: F.get(
        F.array(*map(F.lit, alphabet)), F.pmod(_number(key, label, entity, i.cast("string")), F.lit(len(alphabet))).cast("int")))


def _scripts():
    return [(script, sign) for script, sign in SCRIPTS.items() if script in SYLLABLES]


def _keyed(key, attempt):
    return F.concat(F.lit(f"{key}\0"), attempt.cast("string"))


def _email(key, entity, attempt):
    local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    length = F.greatest(F.char_length(local), F.lit(10)) + 2 * attempt
    spelled = _spelled(_keyed(key, attempt), "local", entity, letters, length)
    shaped = F.transform(spelled, lambda c, i: F.when(
        F.rlike(_cut(local, i + 1, F.lit(1)), F.lit("[0-9]")), F.pmod(F.ascii(c), F.lit(10)).cast("string")).when(
        F.rlike(_cut(local, i + 1, F.lit(1)), F.lit("[._%+-]")), _cut(local, i + 1, F.lit(1))).otherwise(c))
    return F.concat(F.array_join(shaped, ""), F.lit("@"),
                    F.array_join(_spelled(_keyed(key, F.lit(0)), "domain", domain, letters, F.lit(10)), ""), F.lit(".example"))


def _name(key, entity, attempt):
    title = F.regexp_extract(entity, r"^([^ .]+\.? )", 1)
    female = F.rlike(title, F.lit(rf"^(?:{'|'.join(TITLES['f'])})\.? $"))
    names = F.split(F.substring(entity, F.char_length(title) + 1, F.char_length(entity)), " ")

    def renamed(word, i, n):
        def in_script(script):
            syllables = _spelled(_keyed(key, F.lit(attempt)), "name", word, SYLLABLES[script].split(), F.lit(5 + 2 * attempt))
            # A given name, the first of two words, ends as the title's gender has it.
            ending = F.when((n > 1) & (i == 0), F.when(female, ENDINGS[script, "f"]).otherwise(ENDINGS[script, "m"])).otherwise("")
            return F.initcap(F.concat(F.array_join(syllables, ""), ending))

        new = in_script("latin")
        for script, sign in _scripts():
            new = F.when(F.rlike(word, F.lit(sign)), in_script(script)).otherwise(new)
        new = F.when(word == F.upper(word), F.upper(new)).otherwise(new)
        return F.when(F.rlike(word, F.lit(r"^\p{Ll}+$")), word).otherwise(new)

    return F.concat(title, F.array_join(F.transform(names, lambda w, i: renamed(w, i, F.size(names))), " "))


def mentions(text):
    """Array of the entities in a text, as written; null where there is none."""
    may = F.rlike(text, F.lit(_SIGNS))
    for stem in _STEMS:
        may = may | F.contains(text, F.lit(stem))
    return F.when(may & F.rlike(text, F.lit(ANY)), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))


def kind_of(entity):
    """The first kind whose pattern the whole entity fits."""
    found = None
    for kind, pattern in KINDS.items():
        fits = F.rlike(entity, F.lit(rf"^(?:{pattern})$"))
        found = F.when(fits, kind) if found is None else found.when(fits, kind)
    return found


def normalized(kind, entity):
    """What makes two mentions one entity: digits of numbers, small letters of e-mails."""
    return F.when(kind == "email", F.lower(entity)).when(kind.isin("phone", "ssn", "card"), _digits(entity)).otherwise(entity)


def surrogate(key, kind, entity, attempt, attempts):
    """The surrogate of an entity as written.

    ``attempt`` is a column, the attempt number of the entity if it is of a kind drawn one by one;
    ``attempts`` has the number of each other kind.
    """
    drawn = _keyed(key, attempt)
    digits = _digits(entity)
    n = F.char_length(digits)
    head = F.greatest(n - 9, F.lit(1))
    phone = F.concat(_cut(digits, 1, head), _permuted(drawn, "phone", _cut(digits, head + 1, n)))
    body = F.concat(_cut(digits, 1, F.lit(1)), _permuted(drawn, "card", _cut(digits, 2, n - 2)))
    off = F.pmod(_cut(digits, n, F.lit(1)).cast("int") - _luhn(_cut(digits, 1, n - 1)), F.lit(10))
    card = _let(body, lambda b: F.concat(b, F.pmod(_luhn(b) + off, F.lit(10)).cast("string")))
    octets = F.transform(F.split(entity, r"\."), lambda o: o.cast("long"))
    pair = _feistel(drawn, "ip", F.get(octets, F.lit(0)) * 256 + F.get(octets, F.lit(1)),
                    F.get(octets, F.lit(2)) * 256 + F.get(octets, F.lit(3)), F.lit(65536), F.lit(65536))
    ip = _let(pair, lambda p: F.concat_ws(".", *[
        x.cast("string") for x in (F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256)]))
    return (
        F.when(kind == "email", _email(key, F.lower(entity), attempt)).when(kind == "ip", ip)
        .when(kind == "ssn", _in_format(entity, _permuted(drawn, "ssn", digits)))
        .when(kind == "phone", _in_format(entity, phone)).when(kind == "card", _in_format(entity, card))
        .otherwise(_name(key, entity, attempts["name"]))
    )


def found_mentions(documents):
    """``doc_id, text_hash, kind, entity, value`` of every mention: as written, and normalized."""
    found = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(mentions(F.col("text"))).alias("entity"))
    return found.withColumn("kind", kind_of(F.col("entity"))).withColumn("value", normalized(F.col("kind"), F.col("entity")))


def entities(mentioned):
    """``kind, entity, value``, each once."""
    return mentioned.select("kind", "entity", "value").distinct()


def checked_attempts(documents, key, staging, known=None):
    """The first attempt without collisions of the kinds that are drawn together, 0 of the others."""
    known = staging.table(entities(found_mentions(documents)), "entities") if known is None else known
    attempts = dict.fromkeys(KINDS, 0)
    open_kinds = [kind for kind in KINDS if kind not in ONE_BY_ONE]
    while open_kinds:
        drawn = known.filter(F.col("kind").isin(open_kinds)).withColumn(
            "surrogate", surrogate(key, F.col("kind"), F.col("entity"), F.lit(0), attempts))
        drawn = drawn.select("kind", "value", normalized(F.col("kind"), F.col("surrogate")).alias("surrogate")).distinct()
        # A surrogate that two values share, or that is a value of its own kind.
        both = drawn.select("kind", F.col("surrogate").alias("text"), F.lit(1).alias("n")).unionByName(
            drawn.select("kind", F.col("value").alias("text"), F.lit(0).alias("n")).distinct().withColumn("n", F.lit(100)))
        bad = both.groupBy("kind", "text").agg(F.sum("n").alias("n")).filter("n > 1 and n != 100")
        script = F.lit("latin")
        for name, sign in _scripts():
            script = F.when(F.rlike("text", F.lit(rf"{sign}[^ ]*$")), name).otherwise(script)
        found = bad.select("kind", script.alias("script")).distinct().collect()
        # Longer names part words only if there are syllables to choose from.
        for script in {r["script"] for r in found}:
            if len(set(SYLLABLES[script].split())) < 2:
                raise RuntimeError(f"one {script} syllable cannot keep names apart")
        open_kinds = list({r["kind"] for r in found})
        for kind in open_kinds:
            attempts[kind] += 1
    return attempts


def drawn_again(known, key, staging):
    """``kind, value, attempt`` of the entities whose first surrogate does not do; null if there are none."""
    attempts = dict.fromkeys(KINDS, 0)

    def drawn(values):
        new = surrogate(key, F.col("kind"), F.col("entity"), F.col("attempt"), attempts)
        return values.withColumn("surrogate", normalized(F.col("kind"), new))

    # All spellings of a value have the same surrogate, but for signs.
    values = known.filter(F.col("kind").isin(*ONE_BY_ONE)).groupBy("kind", "value").agg(F.min("entity").alias("entity"))
    now = staging.table(drawn(values.withColumn("attempt", F.lit(0))), "drawn")
    for draws in range(MOST_DRAWS + 1):
        owner = F.struct("attempt", "value")
        both = now.select("kind", F.col("surrogate").alias("text"), owner.alias("owner"), F.lit(False).alias("real")).unionByName(
            now.select("kind", F.col("value").alias("text"), F.lit(None).cast("struct<attempt:int,value:string>").alias("owner"),
                       F.lit(True).alias("real")))
        bad = staging.table(both.groupBy("kind", "text").agg(
            F.count("owner").alias("n"), F.min("owner").alias("owner"), F.bool_or("real").alias("real")).filter(
            "n > 1 or n = 1 and real").select("kind", F.col("text").alias("surrogate"), F.when(
                ~F.col("real"), F.col("owner.value")).alias("keeper")), "bad")
        if bad.isEmpty():
            break
        if draws == MOST_DRAWS:
            kinds = sorted(r["kind"] for r in bad.select("kind").distinct().collect())
            raise RuntimeError(f"too many of all possible numbers are real, so surrogates run out: {', '.join(kinds)}")
        judged = now.join(bounded(bad.withColumn("shared", F.lit(True))), ["kind", "surrogate"], "left")
        again = F.col("shared").isNotNull() & ~F.col("value").eqNullSafe(F.col("keeper"))
        # Only the new attempts are computed.
        kept = judged.filter(~again).select("kind", "value", "entity", "attempt", "surrogate")
        new = judged.filter(again).select("kind", "value", "entity", (F.col("attempt") + 1).alias("attempt"))
        now = staging.table(kept.unionByName(drawn(new)), "drawn")
    redrawn = now.filter("attempt > 0").select("kind", "value", "attempt")
    return None if redrawn.isEmpty() else redrawn


def pseudonymized(documents, key, staging):
    """The documents with all entities replaced, and ``entity_counts`` (a map by kind) added.

    ``n_chars``, where there is one, is counted anew.
    """
    mentioned = staging.table(found_mentions(documents), "mentions")
    known = staging.table(entities(mentioned), "entities")
    attempts, redrawn = checked_attempts(documents, key, staging, known), drawn_again(known, key, staging)
    attempt, extra, columns = (lambda kind, entity: F.lit(0)), (), documents.columns
    mine, again, doc_id, text_hash = reserved(documents, "mentions", "redrawn", "mention_id", "mention_hash")
    if redrawn is not None:
        # The attempts of the entities in a text, for the texts that mention one drawn again.
        met = mentioned.join(bounded(redrawn), ["kind", "value"]).groupBy("doc_id", "text_hash").agg(F.map_from_entries(
            F.collect_set(F.struct(F.concat_ws("\0", "kind", "value"), "attempt"))).alias(again))
        met = staging.table(met.withColumnsRenamed({"doc_id": doc_id, "text_hash": text_hash}), "met")
        same = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(text_hash))
        documents = documents.join(bounded(met), same, "left")
        attempt = lambda kind, entity: F.coalesce(F.try_element_at(
            F.col(again), F.concat_ws("\0", kind, normalized(kind, entity))), F.lit(0))
        extra = (again, doc_id, text_hash)
    text = F.col("text")
    found = F.transform(mentions(text), lambda e: F.struct(kind_of(e).alias("kind"), e.alias("entity")))
    marked = documents.withColumn(mine, F.transform(found, lambda m: F.struct(
        m["kind"].alias("kind"), m["entity"].alias("entity"), attempt(m["kind"], m["entity"]).alias("attempt"))))
    pieces = F.arrays_zip(F.split(text, ANY, -1).alias("gap"), F.col(mine).alias("m"))
    replaced = F.array_join(F.transform(pieces, lambda z: F.concat(z["gap"], F.when(
        z["m"].isNotNull(), surrogate(key, z["m"]["kind"], z["m"]["entity"], z["m"]["attempt"], attempts)).otherwise(""))), "")
    counts = F.create_map(*[x for kind in KINDS for x in (
        F.lit(kind), F.coalesce(F.size(F.filter(mine, lambda m: m["kind"] == kind)), F.lit(0)))])
    counts = F.transform_values(counts, lambda _, n: F.greatest(n, F.lit(0)))
    out = fenced(marked, (mine, *extra), text=F.when(F.col(mine).isNotNull(), replaced).otherwise(text),
                 entity_counts=counts)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in columns else out
