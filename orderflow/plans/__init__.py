from orderflow.plans.dossier import QUERY_KEYS, Dossier

__all__ = ["Dossier", "QUERY_KEYS"]
