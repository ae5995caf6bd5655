"""Operators for building training corpora: quality rules, de-duplication,
decontamination, classification, privacy and mixing.  Nothing else in the
package imports this subpackage."""
