"""The layers: bronze to silver, silver to gold, gold to published tables."""
