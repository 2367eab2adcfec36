"""PIPE-7 on a stage store: turns to pairs in stages that a new run finds where the last one stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.constants import PROMPT_COMBINE, PROMPT_REFINE, PROMPT_RESTATE, REFINE_K, TOP_K
from parley.operators import model_stage as ms
from parley.plans import dataset as ds
from parley.plans import retrieval as rt
from parley.plans.store import StageStore


def build_pairs(store: StageStore, turns: DataFrame, names: DataFrame, versions: list[str], model: Callable[[str], ms.ModelFn],
                parts: int = 4, k: int = TOP_K, refine_k: int = REFINE_K) -> tuple[DataFrame, str]:
    """The instruction pairs and their key. ``versions`` are those of the tables behind ``turns`` and ``names``;
    ``model(stage)`` gives the model function of a stage and is asked when its turn comes."""

    def answered(stage: str, requests: DataFrame, key: str, columns: list[str], **parameters) -> tuple[DataFrame, str]:
        asked, asked_key = store.table(f"{stage}-requests", lambda: requests, [key], **parameters)
        responses, version = store.complete(stage, asked, model(stage), parts)
        return store.table(stage, lambda: ms.merge_responses(asked, responses, columns), [asked_key, version])

    speech, speech_key = store.table("speech", lambda: rt.cleaned_speech(turns, names), versions)
    restated, key = answered("restate", ds.restate_requests(rt.requests_from_speech(speech)), speech_key,
                             ["call_id", "spoken"], prompt=PROMPT_RESTATE)
    finished = restated.where("status = 'done'").select("call_id", "spoken", F.col("answer").alias("request"))
    index, key = store.table("index", lambda: rt.build_docs(speech, finished), [speech_key, key])
    vectors, key = store.table("vectors", lambda: rt.doc_vectors(index), [key])
    cands, cands_key = store.table("candidates", lambda: rt.candidates(vectors, k), [key], k=k)
    refined, key = answered("refine", ds.refine_requests(cands, refine_k), cands_key, ["call_id", "rank"],
                            prompt=PROMPT_REFINE, k=refine_k)
    combined, key = answered("combine", ds.combine_requests(refined), key, ["call_id"], prompt=PROMPT_COMBINE)
    return store.table("pairs", lambda: ds.to_pairs(cands.select("call_id", "request"), combined), [cands_key, key])
