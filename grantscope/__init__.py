"""grantscope — privileged access review analytics on Spark DataFrames.

Detection rules, risk scoring, findings, summaries, inventory views and audit
evidence exports, all expressed with the DataFrame / SQL API so that Catalyst
plans them and the work is spread over the cluster.
"""

from grantscope.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
