"""Scans of symbols and what is derived from them."""

from symcube.operators.domains import domain_elements, read_domains
from symcube.operators.scan import SymbolScan, list_symbols, read_slot, read_symbol, scan_symbol

__all__ = ["SymbolScan", "domain_elements", "list_symbols", "read_domains", "read_slot", "read_symbol", "scan_symbol"]
