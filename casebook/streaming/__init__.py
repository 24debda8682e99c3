"""Incremental landing of new site files (S1/S4 on a stream). The reference has no streaming; the
per-entry rules (flags, reimbursement filter, lab parsing) are stateless and apply unchanged to a
file stream. Per-patient steps (labels, features) stay batch jobs over the landed stage."""
