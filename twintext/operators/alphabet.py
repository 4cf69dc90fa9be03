"""Character vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twintext.functions.kernels import character_indexer, gatherer
from twintext.params import END_TOKEN, PADDING_TOKEN, START_TOKEN, UNKNOWN_TOKEN

# The characters of each alphabet, in index order.
SPECIALS = (START_TOKEN, END_TOKEN, PADDING_TOKEN, UNKNOWN_TOKEN)
ENGLISH = (
    " !\"#$%&'()*+,-./0123456789:<=>?@"
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ[\\]^_`"
    "abcdefghijklmnopqrstuvwxyz{|}~"
)
MALAYALAM = (
    " !\"#$%&'()*+,-./0123456789:<=>?@"
    "അആഇഈഉഊഋൠഌഎഏഐഒഓഔ"
    "കഖഗഘങചഛജഝഞടഠഡഢണതഥദധനപഫബഭമയറരഴലളവശഷസഹ"
    "ൺൻർൽൾൿ"
    "ംഃँ"
    "ാിീുൂൃെേൈൊോൗ്"
    "൦൧൨൩൪൫൬൭൮൯"
    "\u200b\u200c\u200d"
)
_CODE_POINTS = 1_114_112

ALPHABETS = {"ml": MALAYALAM, "eng": ENGLISH}


def alphabet(language: str, kind: str = "letter") -> list[str]:
    """Tokens of a language in index order, special tokens first."""
    if language not in ALPHABETS:
        raise ValueError(f"language must be one of {sorted(ALPHABETS)}, not {language!r}")
    if kind != "letter":
        raise ValueError(f"only 'letter' vocabularies exist, not {kind!r}")
    return list(dict.fromkeys([*SPECIALS, *ALPHABETS[language]]))


def alphabet_table(spark: SparkSession, language: str, kind: str = "letter") -> DataFrame:
    """The vocabulary as ``(idx, token)``."""
    return spark.createDataFrame(list(enumerate(alphabet(language, kind))), "idx int, token string")


def vocab_index(vocabulary: DataFrame) -> tuple[dict[int, str], dict[str, int]]:
    """Both directions of a vocabulary table: index to token, token to index.

    A table with more rows than there are characters is refused.
    """
    rows = vocabulary.select("idx", "token").limit(_CODE_POINTS + 1).collect()
    if len(rows) > _CODE_POINTS:
        raise ValueError("not a character vocabulary: too many rows")
    return {r["idx"]: r["token"] for r in rows}, {r["token"]: r["idx"] for r in rows}


def characters(df: DataFrame, row_id: str, text: str = "text") -> DataFrame:
    """The distinct characters of every row: ``(ord, token)``.

    ``ord`` puts together the row and the rank of the character's first place
    in it; one number, so that its minimum can be aggregated by hashing.
    Repetitions go before the rows are multiplied.
    """
    distinct = F.array_distinct(F.array_remove(F.split(F.col(text), ""), ""))
    spots = df.select(F.col(row_id).alias("row"), F.posexplode(distinct).alias("rank", "token"))
    place = F.col("row").cast("decimal(20,0)") * F.lit(_CODE_POINTS).cast("decimal(7,0)")
    return spots.select((place + F.col("rank")).alias("ord"), "token")


def add_distinct_ordered(tokens: DataFrame, token: str = "token", order: str = "ord") -> DataFrame:
    """Each token once, at its first place: ``(token, ord)``."""
    return tokens.groupBy(F.col(token).alias("token")).agg(F.min(order).alias("ord"))


def character_vocabulary(df: DataFrame, row_id: str, text: str = "text") -> DataFrame:
    """The characters of a table numbered in order of first appearance.

    The numbering runs in one task, over distinct characters: there are no more
    of them than Unicode code points.
    """
    distinct = add_distinct_ordered(characters(df, row_id, text))
    return distinct.select(
        (F.row_number().over(Window.orderBy("ord")) - 1).alias("idx"), "token"
    )


def index_characters(text: Column, token_to_index: dict[str, int]) -> Column:
    """``array<int>`` of vocabulary indexes of the characters of ``text``.

    Characters outside the vocabulary get the index of the unknown token, or -1
    if it has none. Runs on Arrow batches, with a lookup per character whose
    cost does not depend on the size of the alphabet.
    """
    by_point = {ord(t): i for t, i in token_to_index.items() if len(t) == 1}
    run = character_indexer(by_point, token_to_index.get(UNKNOWN_TOKEN, -1))
    return F.arrow_udf(run, "array<int>")(text)


def detokenize(indexes: Column, index_to_token: dict[int, str]) -> Column:
    """Text of an ``array<int>`` of vocabulary indexes; unknown indexes fail."""
    run = gatherer({i: t.encode() for i, t in index_to_token.items()}, "index")
    return F.arrow_udf(run, "binary")(indexes.cast("array<int>")).cast("string")
