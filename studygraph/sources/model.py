"""A model as a source: prompts go to an injected callable in tasks, a batch at a time; nothing is called by default."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_retry(call: Callable[[str], str], retries: int = 3, first: float = 5.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
    """call, tried again after a failure: `retries` times, after `first` seconds and twice as long each time, `most` at most."""
    def tried(prompt: str) -> str:
        wait = first
        for left in range(retries, -1, -1):
            try:
                return call(prompt)
            except Exception:
                if not left:
                    raise
                sleep(min(wait, most))
                wait *= 2
        raise AssertionError

    return tried


def canned(answers: Mapping[str, str], default: str = "{}") -> Callable[[str], str]:
    """An offline model: the answer of the first key that the prompt contains."""
    held = dict(answers)
    return lambda prompt: next((v for k, v in held.items() if k in prompt), default)


def ask(prompts: DataFrame, call: Callable[[str], str], id_col: str = "id", prompt_col: str = "prompt") -> DataFrame:
    """(id, response, error) for each prompt; a call that fails gives its message as error. Equal prompts are asked once."""
    distinct = prompts.select(prompt_col).distinct()

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for p in rows[prompt_col]:
                try:
                    out.append((p, call(p), None))
                except Exception as e:
                    out.append((p, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["_p", "response", "error"])

    answers = distinct.mapInPandas(asked, "_p string, response string, error string")
    return prompts.select(id_col, prompt_col).join(answers, F.col(prompt_col).eqNullSafe(F.col("_p"))).select(id_col, "response", "error")
