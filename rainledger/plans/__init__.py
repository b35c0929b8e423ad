"""The three ready plans: weather risk, sales performance, customer segments."""
