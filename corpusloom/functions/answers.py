"""Parsing, matching and rewarding model answers, as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import text as T

# A number, and the factors of units that may stand anywhere after it.
NUMBER = r"[-+]?[0-9]*\.?[0-9]+"
UNITS = (("万亿", 1e12), ("亿", 1e8), ("万", 1e4))

# How answers to a choice question name it; the group that holds the letter.
CHOICE_PATTERNS = (
    (r"答案(选项)?(是|为)：? ?([ABCD])", 3),
    (r"答案(是|为)选项 ?([ABCD])", 2),
    (r"故?选择?：? ?([ABCD])", 1),
    (r"([ABCD]) ?选?项(是|为)?正确", 1),
    (r"正确的?选项(是|为) ?([ABCD])", 2),
    (r"答案(应该)?(是|为)([ABCD])", 3),
    (r"选项 ?([ABCD]) ?(是|为)?正确", 1),
    (r"选择答案 ?([ABCD])", 1),
    (r"答案?：?([ABCD])", 1),
    (r"([ABCD])(选?项)?是?符合题意", 1),
    (r"答案选项：? ?([ABCD])", 1),
    (r"答案(选项)?为(.*?)([ABCD])", 3),
)
# Endings after which the letter nearest to them counts.
CHOICE_ENDINGS = ("当选", "正确")
CHOICES = ("A", "B", "C", "D")

# Words that begin a monologue after a translated answer.
MONOLOGUE = "好的|首先|接下来|然后|最后|检查|确认|用户|原文"


def _first(x: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one."""
    return F.when(F.regexp_like(x, F.lit(pattern)), F.regexp_extract(x, pattern, group))


def _number_after(x: Column) -> Column:
    """First number times the unit that follows somewhere; null without a number."""
    found = F.regexp_extract(x, NUMBER, 0)
    tail = F.regexp_extract(x, rf"(?s){NUMBER}(.*)\z", 1)
    factor = F.lit(1.0)
    for unit, times in reversed(UNITS):
        factor = F.when(F.contains(tail, F.lit(unit)), F.lit(times)).otherwise(factor)
    return found.try_cast("double") * factor


def number(x: Column) -> Column:
    """Commas and white space are deleted first."""
    return _number_after(F.regexp_replace(x, rf"(?U)[,，]|{T.SPACE}", ""))


def number_of_generated(x: Column) -> Column:
    """Deletes ``* #``, white space and CJK punctuation, but not the ASCII comma: ``1,200`` is 1."""
    return _number_after(F.regexp_replace(x, rf"(?U)[*#，。]|{T.SPACE}", ""))


def after_thinking(x: Column) -> Column:
    """What follows the last ``</think>``, stripped; the whole text without one."""
    return T.strip(F.substring_index(x, "</think>", -1))


def without_thinking(x: Column) -> Column:
    """As :func:`after_thinking`; of thinking that never closes, the last number of the last 200 characters."""
    tail = F.when(F.length(x) > 200, F.substring(x, -200, 200)).otherwise(x)
    numbers = F.regexp_extract_all(tail, F.lit(r"(?U)[-+]?[0-9]+\.?[0-9]*\s*(?:万元|亿元|元|%|万|亿)?"), F.lit(0))
    last = F.coalesce(T.strip(F.try_element_at(numbers, F.lit(-1))), F.lit(""))
    open_only = F.contains(x, F.lit("<think>")) & ~F.contains(x, F.lit("</think>"))
    return F.when(open_only, last).otherwise(after_thinking(x))


def tagged_answer(x: Column) -> Column:
    """The first ``<answer>`` body, stripped; null without one."""
    return T.strip(_first(x, r"(?s)<answer>(.*?)</answer>"))


def _near(value: Column, truth: Column) -> Column:
    """Within 0.5, or within 5 % of a truth that is not zero."""
    gap = F.abs(value - truth)
    return (gap < 0.5) | ((truth != 0) & (F.try_divide(gap, F.abs(truth)) < 0.05))


def any_number_near(x: Column, truth: Column) -> Column:
    """Some number of the text is near the truth; the text's units do not count."""
    numbers = F.regexp_extract_all(F.regexp_replace(x, "[,，]", ""), F.lit(NUMBER), F.lit(0))
    return F.exists(numbers, lambda n: F.coalesce(_near(n.try_cast("double"), truth), F.lit(False)))


def same_answer(a: Column, b: Column) -> Column:
    """Symmetric match: equal, near in value, or one within the other."""
    bare = lambda x: F.regexp_replace(T.strip(x), rf"(?U)[*#]|{T.SPACE}", "")
    x, y = bare(a), bare(b)
    m, n = number_of_generated(x), number_of_generated(y)
    gap = F.abs(m - n)
    near = m.isNotNull() & n.isNotNull() & ((gap < 0.5) | (gap / F.greatest(F.abs(n), F.lit(0.01)) < 0.05))
    within = (F.length(x) > 1) & (F.length(y) > 1) & (F.contains(y, x) | F.contains(x, y))
    return (a != "") & (b != "") & ((x == y) | F.coalesce(near, F.lit(False)) | within)


def prediction_matches(prediction: Column, truth: Column) -> Column:
    """A truth with a number needs a near number after thinking; any other must be contained."""
    value = number(truth)
    answer = F.substring_index(prediction, "</think>", -1)
    return F.when(value.isNotNull(), any_number_near(answer, value)).otherwise(F.contains(T.calc_normalised(prediction), T.calc_normalised(truth)))


def check_matches(answer: Column, truth: Column) -> Column:
    """As whole numbers after ``, % 亿 万`` are deleted, within 0.5 or 2 %; else equal or contained either way. A null answer never matches."""
    bare = lambda x: T.strip(F.regexp_replace(x, "[,%亿万]", "")).try_cast("double")
    a, g = bare(answer), bare(T.strip(truth))
    gap = F.abs(a - g)
    near = (gap < 0.5) | (gap / F.greatest(F.abs(g), F.lit(1.0)) < 0.02)
    x, y = T.answer_normalised(answer, T.CHECK_PUNCTUATION), T.answer_normalised(T.strip(truth), T.CHECK_PUNCTUATION)
    return F.when(answer.isNull(), F.lit(False)).when(a.isNotNull() & g.isNotNull(), near).otherwise((x == y) | F.contains(x, y) | F.contains(y, x))


def _nearest_letter(x: Column, ending: str) -> Column:
    """Start from the first letter that the ending follows on its line; the last letter before the ending counts."""
    span = _first(x, rf"(?m)[ABCD].*?{ending}", 0)
    return F.try_element_at(F.regexp_extract_all(span, F.lit("[ABCD]"), F.lit(0)), F.lit(-1))


def choice(x: Column, key: Column, seed: str = "choice") -> tuple[Column, Column]:
    """The letter that a response chooses, and whether it is only a guess (by hash of the key)."""
    own = after_thinking(x)
    found = [_first(own, r"\A([ABCD])")]
    found += [_first(own, f"(?m){pattern}", group) for pattern, group in CHOICE_PATTERNS]
    found += [_nearest_letter(own, ending) for ending in CHOICE_ENDINGS]
    found.append(_first(own, r"(?s)\A[^ABCD]*([ABCD])[^ABCD]*\z"))
    named = F.coalesce(*found)
    guess = F.element_at(F.array(*map(F.lit, CHOICES)), (F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), key.cast("string"))), 1, 8), 16, 10).cast("long"), F.lit(4)) + 1).cast("int"))
    return F.coalesce(named, guess), named.isNull()


def generated_questions(x: Column, most: int | None = None) -> Column:
    """Lines longer than 10 characters once a ``Q:`` or number prefix is off."""
    lines = F.transform(F.split(T.strip(x), "\n"), lambda s: T.strip(F.regexp_replace(T.strip(s), r"(?U)\A(Q\s*[:：]\s*|\d+[.、)\s]+)", "")))
    kept = F.filter(lines, lambda s: F.length(s) > 10)
    return kept if most is None else F.slice(kept, 1, most)


def generated_pair(x: Column) -> tuple[Column, Column]:
    """Problem and answer of a generated exercise; null where either label is missing."""
    q = T.strip(_first(x, r"(?sU)题目[：:]\s*(.*?)(?=\n*答案[：:])"))
    a = T.strip(_first(x, r"(?sU)答案[：:]\s*(.*?)(?:\n|\z)"))
    return F.when(a.isNotNull(), q), F.when(q.isNotNull(), a)


def reasoning_pair(x: Column) -> tuple[Column, Column]:
    """Question line and ``<answer>`` body of a reasoning response."""
    q = T.strip(_first(x, r"(?U)Q\s*[:：]\s*(.+?)(?:\n|\z)"))
    a = tagged_answer(x)
    return F.when(a.isNotNull(), q), F.when(q.isNotNull(), a)


def translated_pair(x: Column) -> tuple[Column, Column]:
    """Question and answer of a translation: the first labelled pair, else the two sides of the first blank line; monologues are cut off."""
    own = T.strip(F.regexp_replace(after_thinking(x), r"(?s)<think>.*?</think>", ""))
    trimmed = lambda s: T.strip(F.get(F.split(s, rf"\n(?:{MONOLOGUE})", 2), 0))
    q1 = T.strip(_first(own, r"(?sU)问题[：:]\s*(.*?)(?=\n*回答[：:])"))
    a1 = trimmed(T.strip(_first(own, r"(?sU)回答[：:]\s*(.*?)(?=\n*问题[：:]|\z)")))
    halves = F.split(own, r"\n\n", 2)
    q2 = T.strip(F.regexp_replace(F.get(halves, 0), r"(?U)\A问题[：:]\s*", ""))
    a2 = trimmed(T.strip(F.regexp_replace(F.get(halves, 1), r"(?U)\A回答[：:]\s*", "")))
    labelled = F.coalesce((q1 != "") & (a1 != ""), F.lit(False))
    halved = F.coalesce((q2 != "") & (a2 != ""), F.lit(False))
    return F.when(labelled, q1).when(halved, q2), F.when(labelled, a1).when(halved, a2)


def format_reward(x: Column) -> Column:
    own = T.strip(x)
    opened, closed = F.contains(own, F.lit("<think>")), F.contains(own, F.lit("</think>"))
    return (
        F.when(own == "", 0.0).when(opened & closed & (F.length(after_thinking(own)) > 0), 1.0)
        .when(opened & closed, 0.3).when(opened, 0.0).otherwise(0.2)
    )


def accuracy_reward(x: Column, truth: Column) -> Column:
    gt, answer = T.strip(truth), after_thinking(x)
    value = number(gt)
    hit = F.when(value.isNotNull(), any_number_near(answer, value)).otherwise(F.contains(T.answer_normalised(answer), T.answer_normalised(gt)))
    return F.when((gt == "") | (answer == ""), 0.0).otherwise(hit.cast("double"))


def length_reward(x: Column) -> Column:
    thought = F.length(_first(x, r"(?s)<think>(.*?)</think>"))
    whole = F.length(T.strip(x))
    return (
        F.when(thought < 20, 0.2).when(thought > 2000, 0.3).when(thought.isNotNull(), 1.0)
        .when(whole < 20, 0.0).when(whole > 50, 0.3).otherwise(0.1)
    )


# Weights of the format, accuracy and length rewards.
REWARD_WEIGHTS = (1.0, 2.0, 0.5)


def rewards(x: Column, truth: Column, weights: tuple[float, float, float] = REWARD_WEIGHTS) -> dict[str, Column]:
    """The three rewards and their weighted sum."""
    parts = {"format_reward": format_reward(x), "accuracy_reward": accuracy_reward(x, truth), "length_reward": length_reward(x)}
    return parts | {"reward": sum((p * w for p, w in zip(parts.values(), weights, strict=True)), F.lit(0.0))}
