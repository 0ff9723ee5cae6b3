from lookback.functions.codes import (code_at, coverage_flag, fill_zero, overlaps,
                                      rule_max_pos, rule_max_pos_col, status_code)

__all__ = ["code_at", "coverage_flag", "fill_zero", "overlaps", "rule_max_pos",
           "rule_max_pos_col", "status_code"]
