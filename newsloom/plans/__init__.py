"""newsloom.plans"""
