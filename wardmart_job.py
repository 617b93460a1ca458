"""``spark-submit wardmart_job.py all --input ... --bronze ... --silver ... --gold ...``"""

from wardmart.cli import main

if __name__ == "__main__":
    main()
