from quarterstone.functions.arrays import exploded
from quarterstone.functions.codes import exchange_prefix, exchange_suffix, norm_code, pub_date
from quarterstone.functions.numeric import MONEY as MONEY_TYPE
from quarterstone.functions.numeric import compound3, exact_sum, growth, money, ratio, safe_div, scaled
from quarterstone.functions.periods import any_q4, eofm
from quarterstone.functions.sqlnames import register_functions

__all__ = [
    "MONEY_TYPE",
    "any_q4", "compound3", "eofm", "exact_sum", "exchange_prefix", "exploded", "exchange_suffix", "growth", "money",
    "norm_code", "pub_date", "ratio", "register_functions", "safe_div", "scaled",
]
