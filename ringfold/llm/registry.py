"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from ringfold.llm.op1_mix import op1_mix
from ringfold.llm.op9_licenses import op9_licenses
from ringfold.llm.op10_lines import SQL as OP10_SQL
from ringfold.llm.op10_lines import op10_lines
from ringfold.llm.op2_rules import SQL as OP2_SQL
from ringfold.llm.op2_rules import op2_rules
from ringfold.llm.op3_decontaminate import op3_decontaminate
from ringfold.llm.op4_secrets import op4_secrets
from ringfold.llm.op5_chat import SQL as OP5_SQL
from ringfold.llm.op5_chat import op5_chat
from ringfold.llm.op6_html import op6_html
from ringfold.llm.op7_minhash import SQL as OP7_SQL
from ringfold.llm.op7_minhash import op7_minhash
from ringfold.llm.op8_language import op8_language

QUERIES = {"op1_mix": op1_mix, "op2_rules": op2_rules, "op3_decontaminate": op3_decontaminate, "op4_secrets": op4_secrets, "op5_chat": op5_chat, "op6_html": op6_html, "op7_minhash": op7_minhash, "op8_language": op8_language, "op9_licenses": op9_licenses, "op10_lines": op10_lines}
ORACLE_SQL: dict[str, str] = {"op2_rules": OP2_SQL, "op5_chat": OP5_SQL, "op7_minhash": OP7_SQL, "op10_lines": OP10_SQL}
