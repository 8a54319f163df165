"""The domains of generated person records."""

CONTINENTS = ("North America", "Asia", "South America", "Europe", "Africa", "Australia")
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALNUM_SPACE = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 "
DIGITS = "0123456789"
ID_MIN, ID_MAX = 0, 50_000_000          # [min, max)
NAME_LEN = (10, 15)
ADDRESS_LEN = (15, 20)
