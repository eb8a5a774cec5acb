"""The registered queries of this subpackage."""

from __future__ import annotations

from aerolake.llm import (best_position, factor_quality, grid_join, merkle, minhash, mixing,
                          pieces, planes, secret_scan, string_kernel, syncmers, url_rules, warc)

QUERIES = {
    "op1_token_planes": planes.op1,
    "op2_closed_syncmers": syncmers.op2,
    "op3_piece_scan": pieces.op3,
    "op4_soft_mixing": mixing.op4,
    "op5_minhash_join": minhash.op5,
    "op6_string_kernel": string_kernel.op6,
    "op7_secret_entropy": secret_scan.op7,
    "op8_url_rules": url_rules.op8,
    "op9_warc_dictionary": warc.op9,
    "op10_grid_order_join": grid_join.op10,
    "op11_factor_machine": factor_quality.op11,
    "op12_best_position": best_position.op12,
    "op13_merkle_witnesses": merkle.op13,
}
