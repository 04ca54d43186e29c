"""Jobs Q1..Q14, their registered test-table forms and oracle SQL."""
