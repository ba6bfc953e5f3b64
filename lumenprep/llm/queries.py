"""The queries of this subpackage and, where SQL can express them, their SQL."""

from .q_bpe import op2_bpe
from .q_chat import OP7_SQL, op7_chat
from .q_counts import op8_counts
from .q_decon import op1_decon
from .q_langid import op6_langid
from .q_lines import op9_lines
from .q_minhash import op10_minhash
from .q_secrets import op5_secrets
from .q_spotsigs import op4_spotsigs
from .q_warc import OP3_SQL, op3_warc

QUERIES = {"op1_decon": op1_decon, "op2_bpe": op2_bpe, "op3_warc": op3_warc, "op4_spotsigs": op4_spotsigs, "op5_secrets": op5_secrets, "op6_langid": op6_langid, "op7_chat": op7_chat, "op8_counts": op8_counts, "op9_lines": op9_lines, "op10_minhash": op10_minhash}
SQL: dict[str, str] = {"op3_warc": OP3_SQL, "op7_chat": OP7_SQL}
