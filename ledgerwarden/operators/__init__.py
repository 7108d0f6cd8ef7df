"""Pure DataFrame operators: SCD2 merges, facts, owner bridge, fraud rules, report."""
