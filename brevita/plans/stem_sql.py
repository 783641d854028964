"""Porter's stemmer in SQL: the counterpart of ``functions.stemming``, over a table of distinct words.

Each step of the paper is one common table expression. A word's letters are written as V and C once a step; since a letter's kind depends on
what lies before it only, the kinds of a stem are a prefix of those of its word.
"""

from __future__ import annotations

from collections.abc import Iterable

from brevita.functions.stemming import SHORT_WORD, STEP_2, STEP_3, STEP_4

# Runs of y are settled from the left, one letter a round.
Y_ROUNDS = 6


def _kinds(word: str) -> str:
    shape = f"regexp_replace(regexp_replace({word}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g')"
    for _ in range(Y_ROUNDS):
        shape = f"regexp_replace({shape}, '^y', 'C')"
        shape = f"regexp_replace(regexp_replace({shape}, 'Cy', 'CV', 'g'), 'Vy', 'VC', 'g')"
    return shape


def _measure_over(kinds: str, least: int) -> str:
    """Whether a stem has more than ``least`` (0 or 1) changes from vowel to consonant."""
    return f"regexp_matches({kinds}, '{'VC.*VC' if least else 'VC'}')"


def _ends_cvc(word: str, kinds: str) -> str:
    return f"(ends_with({kinds}, 'CVC') and right({word}, 1) not in ('w', 'x', 'y'))"


def _longest(suffixes: Iterable[str]) -> str:
    ordered = sorted(suffixes, key=len, reverse=True)
    return "case " + " ".join(f"when ends_with(w, '{s}') then '{s}'" for s in ordered) + " end"


def _step(name: str, source: str, columns: str) -> str:
    """A step as two tables: the words so far with their kinds, and what the step needs to know of them."""
    return f"{name}_in as (select w0, w, {_kinds('w')} as k from {source}),\n{name} as (select *, {columns} from {name}_in)"


def _swap(name: str, source: str, table: dict[str, str]) -> str:
    into = "case suffix " + " ".join(f"when '{a}' then '{b}'" for a, b in table.items()) + " end"
    stem = "len(w) - len(suffix)"
    return f"""{_step(f"{name}_at", source, f"{_longest(table)} as suffix")},
{name} as (select w0, case when suffix is not null and {_measure_over(f"left(k, {stem})", 0)}
  then left(w, {stem}) || {into} else w end as w from {name}_at)"""


def stem_tables(words: str) -> str:
    """Tables of a ``with`` list that end in ``stems`` (w0, w), from a table ``words`` with distinct words ``w0``."""
    stem, rest = "left(w, len(w) - cut)", "left(k, len(k) - cut)"
    doubled = f"(len({stem}) > 1 and substring({stem}, len({stem}), 1) = substring({stem}, len({stem}) - 1, 1) and ends_with({rest}, 'C'))"
    shorter, kinds = "left(w, len(w) - 1)", "left(k, len(k) - 1)"
    dropped, left_over = "left(w, len(w) - len(suffix))", "left(k, len(k) - len(suffix))"
    one = lambda kinds: f"({_measure_over(kinds, 0)} and not {_measure_over(kinds, 1)})"
    return f"""step_1a as (select w0, case when ends_with(w0, 'sses') or ends_with(w0, 'ies') then left(w0, len(w0) - 2)
  when ends_with(w0, 's') and not ends_with(w0, 'ss') then left(w0, len(w0) - 1) else w0 end as w from {words} where len(w0) > {SHORT_WORD}),
{_step("step_1b_at", "step_1a", "case when ends_with(w, 'eed') then 0 when ends_with(w, 'ed') and contains(left(k, len(k) - 2), 'V') then 2 "
       "when ends_with(w, 'ing') and contains(left(k, len(k) - 3), 'V') then 3 else 0 end as cut")},
step_1b as (select w0, case when ends_with(w, 'eed') and {_measure_over("left(k, len(k) - 3)", 0)} then {shorter} when cut = 0 then w
  when regexp_matches({stem}, '(at|bl|iz)$') then {stem} || 'e'
  when {doubled} and right({stem}, 1) not in ('l', 's', 'z') then left({stem}, len({stem}) - 1)
  when {one(rest)} and {_ends_cvc(stem, rest)} then {stem} || 'e' else {stem} end as w from step_1b_at),
{_step("step_1c_at", "step_1b", f"ends_with(w, 'y') and contains({kinds}, 'V') as turns")},
step_1c as (select w0, case when turns then {shorter} || 'i' else w end as w from step_1c_at),
{_swap("step_2", "step_1c", STEP_2)},
{_swap("step_3", "step_2", STEP_3)},
{_step("step_4_at", "step_3", f"{_longest(STEP_4)} as suffix")},
step_4 as (select w0, case when suffix is not null and {_measure_over(left_over, 1)}
  and (suffix <> 'ion' or regexp_matches({dropped}, '[st]$')) then {dropped} else w end as w from step_4_at),
{_step("step_5a_at", "step_4", f"{_measure_over(kinds, 1)} or ({one(kinds)} and not {_ends_cvc(shorter, kinds)}) as falls")},
step_5a as (select w0, case when ends_with(w, 'e') and falls then {shorter} else w end as w from step_5a_at),
{_step("step_5b_at", "step_5a", f"{_measure_over('k', 1)} as longer")},
stems as (select w0, case when ends_with(w, 'll') and longer then {shorter} else w end as w from step_5b_at
  union all select w0, w0 from {words} where len(w0) <= {SHORT_WORD})"""
