"""DataFrame operators: silver, gold ageing, reports, reconciliation, security, checks, dictionary."""
