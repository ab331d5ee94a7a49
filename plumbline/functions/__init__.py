"""Column functions: codes, money, time and text."""
