"""DataFrame operators shared by the reports: lookups, change sets, stored sums, reconciliation."""
