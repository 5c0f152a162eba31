from orderflow.sources.tables import DomainTables, read_domain_tables

__all__ = ["DomainTables", "read_domain_tables"]
