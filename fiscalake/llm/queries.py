"""The queries of this package and their SQL."""

from __future__ import annotations

from fiscalake.llm import (
    bpe,
    chat,
    decontaminate,
    language,
    manifest,
    minhash,
    private,
    quality,
    shards,
    token_files,
    trie,
    urls,
    winnow,
)


def queries():
    return {
        "op1_evidence_fusion": language.op1_evidence_fusion,
        "op2_fm_index": decontaminate.op2_fm_index,
        "op3_url_reputation": urls.op3_url_reputation,
        "op4_snapshot_collapse": chat.op4_snapshot_collapse,
        "op5_segment_tree": bpe.op5_segment_tree,
        "op6_rule_ledger": quality.op6_rule_ledger,
        "op7_minhash": minhash.op7_minhash,
        "op8_sampled_splitters": shards.op8_sampled_splitters,
        "op9_re_pair": token_files.op9_re_pair,
        "op10_weak_supervision": private.op10_weak_supervision,
        "op11_merkle_witnesses": manifest.op11_merkle_witnesses,
        "op12_winnowing": winnow.op12_winnowing,
        "op13_prefix_rollup": trie.op13_prefix_rollup,
    }


def oracle_sql():
    return {
        "op2_fm_index": decontaminate.OP2_SQL,
        "op3_url_reputation": urls.OP3_SQL,
        "op4_snapshot_collapse": chat.OP4_SQL,
        "op6_rule_ledger": quality.OP6_SQL,
        "op11_merkle_witnesses": manifest.OP11_SQL,
        "op13_prefix_rollup": trie.OP13_SQL,
    }
