"""Is a text layer usable? Letters that went missing, fragmented words, and too few function words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import strip_accents, trimmed

# Spanish letter frequencies in per cent, down to the watch line of 0.8.
LETTERS = {"e": 13.7, "a": 12.5, "o": 8.7, "s": 8.0, "r": 6.9, "n": 6.7, "i": 6.2, "d": 5.9, "l": 5.0, "c": 4.7, "t": 4.6, "u": 3.9, "m": 3.2, "p": 2.5, "b": 1.4, "g": 1.0, "v": 0.9, "y": 0.9, "q": 0.9}
# Function words, and the words of one and two letters that Spanish has.
FUNCTION_WORDS = (
    "de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "lo", "como",
    "mas", "pero", "sus", "le", "ya", "o", "este", "si", "porque", "esta", "entre", "cuando", "muy", "sin", "sobre", "tambien", "me", "hasta",
    "hay", "donde", "quien", "desde", "todo", "nos", "durante", "todos", "uno", "les", "ni", "contra", "otros", "ese", "eso", "ante", "ellos",
    "e", "esto", "mi", "antes", "algunos", "unos", "yo", "otro", "otras", "otra", "tanto", "esa", "estos",
)
TWO_LETTERS = (
    "de", "la", "el", "en", "un", "se", "su", "al", "lo", "no", "es", "ni", "si", "ya", "yo", "me", "te", "le", "mi", "tu", "da", "va", "ir", "os",
    "ha", "he", "as", "ex", "id",
)
ONE_LETTER = ("a", "e", "o", "u", "y")
MIN_CHARS, MIN_TOKENS, MIN_LETTERS, LOST, MIN_FUNCTION, MAX_FRAGMENTS = 200, 30, 500, 0.15, 0.18, 0.12
TOKEN = "[a-záéíóúüñ]+"
NO_LAYER, SUSPECT, USABLE = "sin_capa_de_texto", "sospechoso", "usable"


def assess(df: DataFrame, text: str, out: str = "quality") -> DataFrame:
    """``df`` with struct ``out`` (verdict, chars, tokens, function_ratio, fragment_ratio, lost_letters, reasons).

    Words count as they are spelled: an accent makes another word. Letters count as their base
    letters, wherever they stand. Done in steps, as each is used several times by the next one
    and must not be computed again for each use.
    """
    steps = df.withColumn("__l", F.lower(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("\f"), F.lit(" "))))
    steps = steps.withColumns({"__words": F.regexp_extract_all("__l", F.lit(TOKEN), 0), "__flat": F.regexp_replace(strip_accents(F.col("__l")), "[^a-z]+", ""), "__chars": F.length(trimmed(F.col("__l")))})
    # one look at each word: function words are counted below 2**32, fragments above; no word is both
    weigh = lambda w: F.when(w.isin(*FUNCTION_WORDS), 1).when((F.length(w) == 1) & ~w.isin(*ONE_LETTER) | (F.length(w) == 2) & ~w.isin(*TWO_LETTERS), 1 << 32).otherwise(0)
    steps = steps.withColumns({"__n": F.size("__words"), "__both": F.aggregate("__words", F.lit(0).cast("long"), lambda a, w: a + weigh(w).cast("long")), "__total": F.length("__flat")})
    steps = steps.withColumns({"__function": F.col("__both") % (1 << 32), "__short": F.shiftright("__both", 32)})
    rare = [F.when((F.col("__total") >= MIN_LETTERS) & ((F.col("__total") - F.length(F.replace("__flat", F.lit(x), F.lit("")))) * 100.0 / F.col("__total") < LOST * p), F.lit(x)) for x, p in LETTERS.items()]
    some = F.when(F.col("__n") > 0, F.col("__n"))
    steps = steps.withColumns({"__lost": F.array_sort(F.array_compact(F.array(*rare))), "__f": F.col("__function") / some, "__g": F.col("__short") / some, "__bare": (F.col("__chars") < MIN_CHARS) | (F.col("__n") < MIN_TOKENS)})
    bare = F.col("__bare")
    per_cent = lambda c: F.format_string("%.1f%%", c * 100)
    # The wording of the three reasons.
    reasons = F.when(bare, F.array(F.concat(F.lit("solo "), F.col("__chars").cast("string"), F.lit(" caracteres y "), F.col("__n").cast("string"), F.lit(" palabras")))).otherwise(F.array_compact(F.array(
        F.when(F.size("__lost") > 0, F.concat(F.lit("letras casi ausentes frente a lo esperado en espanol: "), F.concat_ws(", ", "__lost"))),
        F.when(F.col("__f") < MIN_FUNCTION, F.concat(F.lit("solo "), per_cent(F.col("__f")), F.lit(f" de palabras funcionales (minimo {MIN_FUNCTION:.0%}): no se lee como prosa"))),
        F.when(F.col("__g") > MAX_FRAGMENTS, F.concat(per_cent(F.col("__g")), F.lit(" de tokens sueltos de una o dos letras: el texto parece partido"))),
    )))
    steps = steps.withColumn("__reasons", reasons)
    result = F.struct(
        F.when(bare, NO_LAYER).when(F.size("__reasons") > 0, SUSPECT).otherwise(USABLE).alias("verdict"), F.col("__chars").alias("chars"), F.col("__n").alias("tokens"),
        F.when(bare, 0.0).otherwise(F.col("__f")).alias("function_ratio"), F.when(bare, 0.0).otherwise(F.col("__g")).alias("fragment_ratio"),
        F.when(bare, F.array().cast("array<string>")).otherwise(F.col("__lost")).alias("lost_letters"), F.col("__reasons").alias("reasons"),
    )
    return steps.select(*df.columns, result.alias(out))
