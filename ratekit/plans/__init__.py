"""End-to-end plans composed from the operators."""

from ratekit.plans.cf import CFResult, centered_knn, cosine_knn
from ratekit.plans.display import list_tables, print_list_tables, print_value_table, value_table
from ratekit.plans.report import cf_report_lines, model_notes, value_report_lines, write_report
from ratekit.plans.values import ValueAnalysis, value_analysis

__all__ = [
    "CFResult",
    "ValueAnalysis",
    "centered_knn",
    "cf_report_lines",
    "cosine_knn",
    "list_tables",
    "model_notes",
    "print_list_tables",
    "print_value_table",
    "value_analysis",
    "value_report_lines",
    "value_table",
    "write_report",
]
