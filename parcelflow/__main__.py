from parcelflow.streaming.job import main

if __name__ == "__main__":
    main()
