"""orderflow: purchase-campaign follow-up analytics on Spark.

A campaign is a (brand ``Marque``, season ``Saison``) pair.  Every table of the
dossier carries those two columns, so all campaigns are computed in one
distributed job instead of a Python loop over campaigns.

Entry points:

* :class:`orderflow.plans.dossier.Dossier` builds every output as a lazy
  DataFrame from the domain tables (:class:`orderflow.sources.tables.DomainTables`).
* :func:`orderflow.sources.adapter.domain_from_tpch` derives the domain tables
  from the TPC-H style test tables.
* :func:`orderflow.plans.sink.write_dossier` writes every output, partitioned
  by campaign.
"""

from orderflow.plans.dossier import QUERY_KEYS, Dossier
from orderflow.session import build_session, ensure_checkpoint_dir

__all__ = ["Dossier", "QUERY_KEYS", "build_session", "ensure_checkpoint_dir"]
