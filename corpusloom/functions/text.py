"""Text normalisers, splitters, tokenizers and n-grams as Column builders.

All builders treat text by code points and use Unicode white space, and a null
text is an empty one unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode defines it, and what else strip() and \s take.
SPACE = r"[\s\x1c-\x1f\x85]"
#: The same characters one by one.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

# Characters that the normaliser for duplicates deletes.
DUP_PUNCTUATION = "。．，,、;；:：!?！？\"'（）()[]【】<>《》-—_"
# Characters that the answer normalisers delete besides white space.
REWARD_PUNCTUATION = "，。、；：\"'！？,.:;!?-()（）"
CHECK_PUNCTUATION = "，。、；：\"'！？,.:;!?-()"

# Words that are no keywords of a prompt.
PROMPT_STOPWORDS = ("什么", "哪些", "如何", "为什么", "怎么", "需要", "可以", "吗", "的", "了", "和", "是", "在", "有", "与", "及", "一个", "一种", "是否", "进行", "对于", "应当", "应该", "请问", "一下", "有关")

# Words that say nothing about a topic.
TOPIC_STOPWORDS = tuple(
    """的 了 在 是 我 有 和 就 不 人 都 一 上 也 很 到 说 要 去 你 会 着 没有 看 好 自己 这
    那 它 他 她 们 个 之 与 及 以 或 但 而 等 啊 哦 嗯 呢 吧 吗 呀 哈 嘛 哟 唉 啦 罢 已经
    什么 怎么 为什么 如何 哪里 哪个 哪些 多少 几 谁 何 那么 这么 这样 那样 这种 那种
    请 是否 可以 能否 应该 需要 必须 最 比较 一些 一下 一点 几个 一般 通常 经常""".split()
)

CJK = r"\x{4e00}-\x{9fff}"


def escaped(characters: str) -> str:
    """A regular-expression class of these characters."""
    return "[" + "".join("\\" + c if c in r"[]\^-&" else c for c in characters) + "]"


def text_of(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))


def strip(x: Column) -> Column:
    """White space off both ends, all of Unicode's."""
    return F.btrim(x, F.lit(SPACES))


def dup_normalised(x: Column) -> Column:
    """Stripped, lower-cased, white space collapsed, and only then punctuation deleted: ``a , b`` keeps two spaces."""
    return F.translate(F.regexp_replace(F.lower(strip(x)), rf"(?U){SPACE}+", " "), DUP_PUNCTUATION, "")


def compacted(x: Column) -> Column:
    """Lower-cased without any white space; punctuation stays."""
    return F.regexp_replace(F.lower(x), rf"(?U){SPACE}+", "")


def unspaced(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U){SPACE}+", "")


def newline_normalised(x: Column) -> Column:
    """Line ends as LF, no blanks before them, at most one blank line, stripped."""
    lines = F.regexp_replace(x, r"\r\n?", "\n")
    lines = F.regexp_replace(lines, r"[ \t]+\n", "\n")
    return strip(F.regexp_replace(lines, r"\n{3,}", "\n\n"))


def answer_normalised(x: Column, punctuation: str = REWARD_PUNCTUATION) -> Column:
    """Lower-cased without white space and punctuation."""
    return strip(F.lower(F.regexp_replace(F.regexp_replace(x, rf"(?U){SPACE}", ""), escaped(punctuation), "")))


def calc_normalised(x: Column) -> Column:
    return F.regexp_replace(F.lower(x), rf"(?U)[，。]|{SPACE}", "")


def tokens(x: Column) -> Column:
    """Each CJK character, and each run of ASCII letters, digits and underscores, of the lower-cased text."""
    return F.regexp_extract_all(F.lower(x), F.lit(rf"[{CJK}]|[a-zA-Z0-9_]+"), F.lit(0))


def sentences(x: Column) -> Column:
    """Non-empty stripped parts between sentence ends; the ASCII full stop is none."""
    return F.filter(F.transform(F.split(x, r"[。！？；;\n]+"), strip), lambda s: s != "")


def prompt_keywords(x: Column, stopwords: Sequence[str] = PROMPT_STOPWORDS) -> Column:
    """Distinct CJK runs and words of two characters or more, in order of appearance."""
    found = F.regexp_extract_all(F.lower(x), F.lit(rf"[{CJK}]{{2,}}|[a-zA-Z0-9_]+"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda t: (F.length(t) >= 2) & ~t.isin(*stopwords)))


def ngrams(x: Column, n: int) -> Column:
    """Character n-grams; a shorter text is its own gram, an empty one has none."""
    none = F.array().cast("array<string>")
    return F.when(x == "", none).when(F.length(x) <= n, F.array(x)).otherwise(F.regexp_extract_all(x, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1)))


def topic_tokens(x: Column, stopwords: Sequence[str] = TOPIC_STOPWORDS) -> Column:
    """ASCII words, then pairs of neighbouring CJK characters that are no stopwords."""
    words = F.regexp_extract_all(x, F.lit(r"[A-Za-z]+"), F.lit(0))
    pairs = F.regexp_extract_all(x, F.lit(rf"(?=([{CJK}]{{2}}))[{CJK}]"), F.lit(1))
    return F.concat(words, F.filter(pairs, lambda t: ~t.isin(*stopwords)))


#: Default token counter; pass another Column builder where a tokenizer is at hand.
TokenLength = Callable[[Column], Column]


def token_length(x: Column) -> Column:
    return F.size(tokens(x))


def cjk_share_over(x: Column, share: float) -> Column:
    """More than this share of the characters are CJK; an empty text never is."""
    return F.regexp_count(x, F.lit(rf"[{CJK}]")) > F.length(x) * F.lit(share)


def paragraphs(x: Column, least: int = 100, most: int = 1500) -> Column:
    """Paragraphs of a text: cut at blank lines and at ``。`` before a line end, too short ones dropped, too long ones
    filled up sentence by sentence.  A single sentence is never cut, so a paragraph may exceed ``most``."""
    none = F.array().cast("array<string>")

    def flushed(a: Column) -> Column:
        return F.when(F.length(a["chunk"]) >= least, F.concat(a["out"], F.array(strip(a["chunk"])))).otherwise(a["out"])

    def add(a: Column, s: Column) -> Column:
        full = F.length(a["chunk"]) + F.length(s) > most
        return F.struct(F.when(full, s).otherwise(F.concat(a["chunk"], s)).alias("chunk"), F.when(full, flushed(a)).otherwise(a["out"]).alias("out"))

    def cut(p: Column) -> Column:
        packed = F.aggregate(F.split(p, r"(?<=[。！？])"), F.struct(F.lit("").alias("chunk"), none.alias("out")), add, flushed)
        return F.when(F.length(p).between(least, most), F.array(p)).when(F.length(p) > most, packed).otherwise(none)

    return F.flatten(F.transform(F.transform(F.split(x, r"\n{2,}|。(?U:\s)*\n"), strip), cut))
